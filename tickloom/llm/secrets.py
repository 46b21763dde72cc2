"""Secret scans: sure patterns, and weak parts that count only together.

A pattern's matches are marked in the text, which is then split at the marks: lengths of the pieces are all that goes on, and
running totals of them are the places.  Weak parts (identifiers, credentials, endpoints) are joined by interval within scopes
of ``SCOPE`` characters: a part is reported if a complementary one begins within that distance.  A credential without a name
counts beside one other part if it mixes digits, lower and upper case; with a digit and a letter alone (keys of one case, UUIDs)
it counts where an identifier and an endpoint are both in scope.  Per document, scope and role only the first and last begin
take part in the join, so many parts close together do not multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import text_of
from tickloom.session import written

#: Kind -> (text before the value, value, least length of the value).
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 6)
ACCESS = ("", r"AKIA[A-Z0-9]+", 20)
HEX = ("", r"[0-9a-f]+", 24)
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}

#: Parts that are weak alone.
WEAK = {
    "identifier": (r"""(?i:client|account|access|app|user|login)[_-]?(?i:id|key|name)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9_.@-]+", 4),
    "credential": ("", r"[A-Za-z0-9+/_=-]{16,}", 16),
    "endpoint": ("", r"""(?i:https?|ftps?|s3|jdbc:[a-z]+|mongodb|postgres|redis|amqp)://[^\x20\x09-\x0D"'<>]+""", 10),
}
#: A credential without a name needs these, and is mixed if it has all of the others.
NEEDED, MIXED = [r"[0-9]", r"[A-Za-z]"], [r"[a-z]", r"[A-Z]"]
#: role of each kind, and the roles that complete it.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "identifier": "id", "credential": "secret", "endpoint": "place"}
COMPLETES = {"id": ["secret"], "secret": ["id", "place"], "place": ["secret"]}
ORDER = {kind: i for i, kind in enumerate([*BASE, *WEAK])}
SCOPE = 400

MARK, PART, OTHER = "\x00", "\x02", "\x01"


def _pieces(text: Column, kind: str) -> Column:
    """The text cut at the matches of one kind, as ``(chars, found)``; every second piece is a match."""
    before, value, least = (BASE | WEAK)[kind]
    marked = F.regexp_replace(text, F.lit(f"({before})({value})"), F.lit(f"{MARK}$1{PART}$2{MARK}"))

    def piece(p: Column, i: Column) -> Column:
        match = i % 2 == 1
        body = F.split_part(p, F.lit(PART), F.lit(2))
        good, mixed = match & (F.char_length(body) >= least), F.lit(True)
        if kind == "credential":
            for needed in NEEDED:
                good = good & body.rlike(needed)
            for needed in MIXED:
                mixed = mixed & body.rlike(needed)
        return F.struct((F.char_length(p) - F.when(match, 1).otherwise(0)).alias("chars"), good.alias("found"), mixed.alias("mixed"))

    cut = F.transform(F.split(marked, MARK), piece)
    return F.when(F.exists(cut, lambda x: x["found"]), cut)


def _near(parts: DataFrame, scope: int, completed: Column) -> DataFrame:
    """Per text, bin and role that is completed: the first and last begin, under the bin and its neighbours."""
    bins = parts.groupBy("row", "bin", "role").agg(F.min("start").alias("first"), F.max("start").alias("last")).withColumn("completed", completed)
    return bins.select(
        F.col("row").alias("n_row"), F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("n_bin"), "completed", "first", "last")


def _beside(weak: DataFrame, near: DataFrame, scope: int) -> DataFrame:
    """Parts that have a completing one within the scope."""
    return weak.join(
        near,
        (F.col("row") == F.col("n_row")) & (F.col("bin") == F.col("n_bin")) & (F.col("role") == F.col("completed"))
        & (F.col("first") <= F.col("start") + scope) & (F.col("last") >= F.col("start") - scope),
        "left_semi",
    )


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """``(row, id)`` of all documents and ``(row, kind, start, end)`` of all reported spans, in code points, end exclusive.

    Weak parts that overlap a base span are that span.  ``row`` numbers the documents' rows, so repeated ids stay apart.
    """
    text = F.replace(F.replace(text_of(text_col), F.lit(MARK), F.lit(OTHER)), F.lit(PART), F.lit(OTHER))
    slim = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    pieces = [F.when(cut.isNotNull(), F.struct(F.lit(kind).alias("kind"), cut.alias("cut"))) for kind, cut in ((k, _pieces(F.col("t"), k)) for k in ORDER)]
    scanned = written(slim.select("id", F.array_compact(F.array(*pieces)).alias("hits")).withColumn("row", F.monotonically_increasing_id()), "secret-hits")

    rows = scanned.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select(
        "row", "hit.kind", F.posexplode("hit.cut").alias("no", "piece"))
    upto = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)  # the pieces of one text
    found = rows.withColumn("end", F.sum("piece.chars").over(upto)).filter("piece.found").select(
        "row", "kind", (F.col("end") - F.col("piece.chars")).alias("start"), "end", "piece.mixed")

    base = F.col("kind").isin(list(BASE))
    in_text = Window.partitionBy("row").orderBy("start")
    covered = F.max(F.when(base, F.col("end"))).over(in_text.rangeBetween(Window.unboundedPreceding, 0)) > F.col("start")
    next_base = F.min(F.when(base, F.col("start"))).over(in_text.rangeBetween(0, Window.unboundedFollowing)) < F.col("end")
    role = F.element_at(F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair]), F.col("kind"))
    parts = written(
        found.withColumn("role", role).withColumn("bin", F.floor(F.col("start") / scope)).withColumn("over", covered).withColumn("next", next_base)
        .filter(base | ~(F.coalesce("over", F.lit(False)) | F.coalesce("next", F.lit(False)))).drop("over", "next"),
        "secret-parts",
    )

    plain = parts.filter(~F.col("mixed"))
    for role in ("id", "place"):
        plain = _beside(plain, _near(parts.filter(F.col("mixed") & (F.col("role") == role)), scope, F.lit("secret")), scope)
    taking_part = written(parts.filter("mixed").unionByName(plain), "secret-taking-part")
    completes = F.create_map(*[x for r, others in COMPLETES.items() for x in (F.lit(r), F.array(*[F.lit(o) for o in others]))])
    linked = _beside(taking_part.filter(~base), _near(taking_part, scope, F.explode(F.element_at(completes, F.col("role")))), scope)
    return scanned.select("row", "id"), parts.filter(base).select("row", "kind", "start", "end").unionByName(linked.select("row", "kind", "start", "end"))


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``found``, an array of ``(start, no, end, kind)`` in order; one row per document, also where nothing is found.

    A null text counts as empty.  An empty table gives no rows.
    """
    rows, found = spans(docs, id_col, text_col)
    no = F.element_at(F.create_map(*[F.lit(x) for pair in ORDER.items() for x in pair]), F.col("kind"))
    gathered = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", no.alias("no"), "end", "kind"))).alias("found"))  # of one text
    empty = F.array().cast("array<struct<start:bigint,no:int,end:bigint,kind:string>>")
    return rows.join(gathered, "row", "left").select("id", F.coalesce("found", empty).alias("found"))

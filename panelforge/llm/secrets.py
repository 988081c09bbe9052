"""Secret scans: base patterns, and multipart credentials linked by an interval join of their parts.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import materialise

#: Parts are linked if at most so many code points lie between them (next start less previous end).
SCOPE = 400


@dataclass(frozen=True)
class Kind:
    """``part``: what it is of a credential (access, secret, endpoint). ``weak``: reported only beside its complement.
    ``least``: fewest characters of ``group``. ``also``: a pattern that the match must hold besides."""

    name: str
    pattern: str
    part: str
    weak: bool = False
    group: int = 0
    least: int = 1
    also: str | None = None


# Fixed values of the contract (base kinds, in the order in which ties are listed), then the weak kinds.
BASE = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "secret", group=2, least=6),
    Kind("access", r"AKIA[A-Z0-9]+", "access", least=20),
    Kind("hex", r"[0-9a-f]{24,}", "secret"),
)
WEAK = (
    Kind("key", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])", "secret", weak=True, also=r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])"),
    Kind("identifier", r"""(?i:client_?id|account(?:_?id)?|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+_.-]{3,})""", "access", weak=True),
    Kind("endpoint", r"""(?<![A-Za-z])(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?|s3|ftp)://[^\s"'<>]+""", "endpoint", weak=True),
)


def _rows(docs: DataFrame, text_col: str, kinds: tuple[Kind, ...]) -> DataFrame:
    """A row (place, kind index, part, number, gap, size, ok) for each match, one of nulls for a text without any."""
    source = docs.withColumn("text__", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    for k, kind in enumerate(kinds):
        source = source.withColumn(f"m{k}__", F.regexp_extract_all("text__", F.lit(kind.pattern), F.lit(0)))
    each = [F.when(F.size(f"m{k}__") > 0, _structs(k, kind)).otherwise(F.array().cast(f"array<{MATCH}>")) for k, kind in enumerate(kinds)]
    return source.withColumn("found__", F.concat(*each)).drop("text__", *[f"m{k}__" for k in range(len(kinds))])


MATCH = "struct<kind:int,gap:int,size:int,ok:boolean>"


def _structs(k: int, kind: Kind) -> Column:
    """Each match with the length of the text between it and the one before."""
    between = F.slice(F.split("text__", kind.pattern, -1), 1, F.size(f"m{k}__"))
    one = lambda gap, match: F.struct(F.lit(k).alias("kind"), F.length(gap).alias("gap"), F.length(match).alias("size"), _passes(match, kind).alias("ok"))
    return F.zip_with(between, F.col(f"m{k}__"), one)


def _passes(match: Column, kind: Kind) -> Column:
    value = F.regexp_extract(match, kind.pattern, kind.group) if kind.group else match
    ok = F.length(value) >= kind.least
    return ok & match.rlike(kind.also) if kind.also else ok


def find_secrets(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", base: tuple[Kind, ...] = BASE, weak: tuple[Kind, ...] = WEAK, scope: int = SCOPE) -> DataFrame:
    """(``id_col``, spans, credentials) of each row of ``docs``; spans: array of (start, kind, end, weak), in order of
    start, then kind as listed; code points, end exclusive. credentials: array of (secret, access, endpoint), the starts of
    each reported secret that has an access identifier within ``scope``, of the nearest such identifier, and of the
    nearest endpoint (null if there is none); the earlier of two as near.

    Base kinds: leftmost matches that do not overlap, kind by kind; matches that are too short are dropped (they
    still cover their text). Weak ones are reported only where their complement is at most ``scope`` code points away
    (next start less previous end): a bare key beside an access identifier, an identifier beside a secret, an endpoint
    beside both. A weak match with the place of a base one is left out.

    One shuffle, by row, of match lengths; texts stay where they are read. The parts are then joined by their intervals,
    in cells of their text. Null or empty text: no spans; very long ones are scanned whole. Null ids stay, repeated
    rows are scanned each, other columns take no part, an empty table gives no row.
    """
    kinds = (*base, *weak)
    listed = _rows(docs.select(id_col, text_col), text_col, kinds).withColumn("row", F.monotonically_increasing_id())
    flat = listed.select("row", id_col, F.posexplode_outer("found__").alias("pos", "m")).select("row", id_col, "pos", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("pos")
    start = F.sum(F.col("gap") + F.col("size")).over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = flat.repartition("row").withColumn("start", start.cast("long")).withColumn("end", (F.col("start") + F.col("size")).cast("long"))
    placed = materialise(placed.where("ok is null or ok").select("row", id_col, "kind", "start", "end"), "parts")
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("kind") + 1)
    placed = placed.withColumns({"part": at([k.part for k in kinds]), "weak": at([k.weak for k in kinds])})
    nearest = _nearest(placed.where("kind is not null").select("row", "kind", "part", "start", "end"), scope)
    judged = placed.join(nearest, ["row", "kind", "start"], "left")
    has = lambda part: F.col(part).isNotNull()
    linked = F.when(F.col("part") == "secret", has("access")).when(F.col("part") == "access", has("secret")).otherwise(has("access") & has("secret"))
    hidden = F.coalesce(F.max(F.when(~F.col("weak"), F.lit(True))).over(Window.partitionBy("row", "start")), F.lit(False))
    judged = judged.withColumn("keep", F.col("kind").isNotNull() & (~F.col("weak") | (linked & ~hidden)))
    span = F.struct("start", F.col("kind").alias("rank"), "end")
    credential = F.struct(F.col("start").alias("secret"), F.col("kind").alias("rank"), "access", "endpoint")
    whole = F.col("keep") & (F.col("part") == "secret") & has("access")
    spans = judged.groupBy("row", id_col).agg(F.sort_array(F.collect_set(F.when(F.col("keep"), span))).alias("s"), F.sort_array(F.collect_set(F.when(whole, credential))).alias("c"))
    name = F.array(*[F.lit(k.name) for k in kinds])
    made = F.transform("s", lambda x: F.struct(x["start"], F.element_at(name, x["rank"] + 1).alias("kind"), x["end"], (x["rank"] >= len(base)).alias("weak")))
    return spans.select(id_col, made.alias("spans"), F.transform("c", lambda x: F.struct(x["secret"], x["access"], x["endpoint"])).alias("credentials"))


def _nearest(parts: DataFrame, scope: int) -> DataFrame:
    """(row, kind, start, access, secret, endpoint): the start of the nearest part of each other sort at most ``scope``
    away from a part of ``parts`` (row, kind, part, start, end), for those that have any.

    An interval join: a part is put into the cells of its text that it covers, and on the other side into those that it
    covers with ``scope`` around it; parts that meet are held against each other in the first cell they share. Matches of a
    kind don't overlap, so the parts within ``scope`` of one are bounded, however many its text holds.
    """
    cell = lambda c: F.floor(c / scope).cast("long")
    left = parts.withColumn("first", cell(F.col("start"))).withColumn("cell", F.explode(F.sequence("first", cell(F.col("end")))))
    around = parts.select("row", F.col("part").alias("other"), F.col("start").alias("from"), F.col("end").alias("to"))
    around = around.withColumn("second", cell(F.col("from") - scope)).withColumn("cell", F.explode(F.sequence("second", cell(F.col("to") + scope))))
    apart = F.greatest(F.col("from") - F.col("end"), F.col("start") - F.col("to"), F.lit(0))
    met = left.join(around, ["row", "cell"]).where((F.col("part") != F.col("other")) & (F.col("cell") == F.greatest("first", "second")) & (apart <= scope))
    of = lambda part: F.min(F.when(F.col("other") == part, F.struct(apart, "from")))["from"].alias(part)
    return met.groupBy("row", "kind", "start").agg(of("access"), of("secret"), of("endpoint"))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat(x["kind"], F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_secrets``."""
    only = lambda name: F.filter("spans", lambda x: x["kind"] == name)
    count = lambda name: F.size(only(name)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spelled(F.filter("spans", lambda x: ~x["weak"])).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )

"""Secrets in text, with credentials of several parts linked.

Strong findings (an assigned password, an access identifier, a long hex run) stand for
themselves. A bare token or an endpoint alone means little; it is reported when the parts that
complete it lie in the same scope of the same text. The parts are joined as intervals: scopes
are cut into bins, a part that anchors a scope goes to its bin and the two beside it, and a
weak candidate looks for anchors in its own bin. It is a semi-join, so it returns a candidate
once however many anchors there are, and a bin holds few of them since findings of a kind do
not overlap.

Everything here is a Spark expression or join; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.sinks.scratch import pin

#: What is looked for. Group 2 of an assignment is its value.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A bare token: base64-like, 32 to 64 characters, with a digit, a capital and a small letter.
BARE = (
    r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{32})(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])"
    r"(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{32,64}={0,2}(?![A-Za-z0-9+/=_-])"
)
ENDPOINT = r"(?<![A-Za-z])(?:https?|s3|ftp|jdbc:[a-z]+|amqps?|redis|mongodb)://[A-Za-z0-9._~:@/?&=%+-]+"

#: Shortest value of an assignment.
LEAST_VALUE = 6
#: Parts belong together if they begin at most this many code points apart.
SCOPE = 512

#: In the order in which they are listed where they begin together.
KINDS = ("assign", "access", "hex", "secret", "endpoint")

_SPAN = "array<struct<start: long, kind: int, end: long>>"


_MATCH = "array<struct<gap: long, size: long, long: boolean>>"


def _matches(text: Column, pattern: str, value: int = 0, least: int = 0) -> Column:
    """The matches of ``pattern``, leftmost and without overlaps: code points since the match
    before, code points of the match, and whether its group ``value`` has ``least`` of them."""
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    parts = [F.split(text, pattern, -1).alias("gap"), whole.alias("whole")]
    if value:
        parts.append(F.regexp_extract_all(text, regex, F.lit(value)).alias("value"))

    def sizes(m: Column) -> Column:
        long = F.length(m["value"]) >= least if value else F.lit(True)
        return F.struct(
            F.length(m["gap"]).cast("bigint").alias("gap"),
            F.length(m["whole"]).cast("bigint").alias("size"),
            F.coalesce(long, F.lit(False)).alias("long"),
        )

    # There is one more gap than there are matches.
    found = F.filter(F.arrays_zip(*parts), lambda m: m["whole"].isNotNull())
    found = F.transform(found, sizes).cast(_MATCH)
    none = F.array().cast(_MATCH)
    return F.when(F.coalesce(F.regexp_like(text, regex), F.lit(False)), found).otherwise(none)


def _placed(matches: DataFrame) -> DataFrame:
    """(digest, span) of each match of (digest, found), where ``found`` has a list per kind.

    A match begins after all matches before it and all text between them, so its place is a
    running sum. The sums are windows over the matches of a text and kind, which Spark sorts and
    streams: the cost grows with the number of findings, not with its square.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"found.{n}").alias("m")) for k, n in enumerate(KINDS)])
    listed = matches.select("digest", F.explode(kinds).alias("of"))
    each = listed.select("digest", "of.kind", F.posexplode("of.m").alias("pos", "m"))
    before = Window.partitionBy("digest", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
    ended = each.withColumn("_end", end).filter("m.long")
    span = F.struct((F.col("_end") - F.col("m.size")).alias("start"), "kind", F.col("_end").alias("end"))
    return ended.select("digest", span.alias("span"))


def _written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _near(weak: DataFrame, anchors: DataFrame) -> DataFrame:
    """The weak candidates that begin within the scope of an anchor of the same text."""
    bin_of = F.call_function("div", F.col("span.start"), F.lit(SCOPE))
    beside = anchors.withColumn(
        "_bin", F.explode(F.array(bin_of - 1, bin_of, bin_of + 1))
    ).select(F.col("digest").alias("_digest"), "_bin", F.col("span.start").alias("_start"))
    own = F.call_function("div", weak["span.start"], F.lit(SCOPE))
    return weak.join(
        beside,
        (weak["digest"] == F.col("_digest"))
        & (own == F.col("_bin"))
        & (F.abs(weak["span.start"] - F.col("_start")) <= SCOPE),
        "left_semi",
    )


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus ``spans``: sorted structs of start, kind (index in
    ``KINDS``) and end, in code points, end exclusive.

    Assignments, access identifiers and hex runs are always there. A bare token is there if
    an access identifier begins within ``SCOPE`` of it, an endpoint if both an access
    identifier and a secret (assigned, hex or bare) do.

    Null and empty texts have no spans. Findings depend on the text alone, so parts are joined
    by text digest, once per distinct text: repeated rows, repeated or null ids and groups of
    copies of any size come out alike. A ``spans`` column is replaced.
    """
    kept = [c for c in docs.columns if c not in (text, "spans")]
    whole = F.coalesce(F.col(text), F.lit(""))
    patterns = {
        "assign": _matches(whole, ASSIGN, 2, LEAST_VALUE),
        "access": _matches(whole, ACCESS),
        "hex": _matches(whole, HEX),
        "secret": _matches(whole, BARE),
        "endpoint": _matches(whole, ENDPOINT),
    }
    found = F.struct(*[c.alias(k) for k, c in patterns.items()])
    scanned = docs.select(
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("_own"),
        F.sha2(whole, 256).alias("_sha"),
        found.alias("_found"),
    )
    any_found = reduce(lambda a, b: a | b, [F.size(f"_found.{k}") > 0 for k in KINDS])
    own = [F.col("_own"), F.when(any_found, F.col("_sha")).alias("_digest")]
    scanned = pin(scanned.select(*own, F.when(any_found, F.col("_found")).alias("_found")), "secrets")
    texts = (
        scanned.filter("_digest IS NOT NULL")
        .groupBy(F.col("_digest").alias("digest"))
        .agg(F.first("_found").alias("found"))
    )
    parts = pin(_placed(texts), "parts")

    def of(*kinds: str) -> DataFrame:
        return parts.filter(F.col("span.kind").isin([KINDS.index(k) for k in kinds]))

    base = of("assign", "access", "hex")
    tokens = _near(of("secret"), of("access"))
    endpoints = _near(_near(of("endpoint"), of("access")), of("assign", "hex").union(tokens))
    # Stored, so that the join has plain shuffles and a hot text's rows may be split.
    spans = pin(
        base.union(tokens).union(endpoints)
        .groupBy(F.col("digest").alias("_text"))
        .agg(F.array_sort(F.collect_list("span")).alias("_spans")),
        "spans",
    )
    none = F.array().cast(_SPAN)
    return scanned.join(spans, F.col("_digest") == F.col("_text"), "left").select(
        *[F.col(f"_own.`{c}`") for c in kept], F.coalesce("_spans", none).alias("spans")
    )


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document with its findings, counted and written out."""
    found = find_secrets(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        n = KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )

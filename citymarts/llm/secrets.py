"""Secret scan with multipart credential linking, in native expressions only.

Base findings (assignments of secrets, access identifiers, hexadecimal keys)
are reported wherever they occur. Weaker candidates are parts of a credential:
user names, mixed-character tokens, short passwords and endpoints. A part is
reported only if a complementary part lies in its scope, i.e. within ``SCOPE``
characters: an identifier or an endpoint needs a secret, a secret needs an
identifier or an endpoint. Base findings count as parts too.

The link is an interval join: parts are entered in every bin of ``SCOPE``
characters that they touch, bins keep the smallest start and the largest end
per document and role, and a candidate looks into the bins that its scope
touches. Any two parts in one scope meet in such a bin, inner bins lie wholly
in the scope, and for the two outer ones the kept ends decide, so the result
is that of comparing all parts, without pairs.

Defined results: a NULL text is an empty one and has no findings; a NULL id is
kept; repeated rows give repeated results; an empty table gives an empty
result. Other columns are not read. Positions are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citymarts.llm.components import written
from citymarts.llm.spans import with_masked, with_matches, written_spans

SCOPE = 200
#: kind: (role, pattern, SQL over the match ``x`` that it must satisfy). Quantifiers are possessive where
#: what follows cannot match the same character, so no text makes them backtrack.
BASE = {
    "assign": ("secret", r"(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+[A-Za-z0-9+/_.=-]++",
               r"length(regexp_extract(x, '[:=]\\x20*+[\"\']?+([A-Za-z0-9+/_.=-]++)$', 1)) >= 12"),
    "access": ("identifier", r"AKIA[A-Z0-9]++", "length(x) >= 18"),
    "hex": ("secret", r"[0-9a-f]{16,}+", "length(x) >= 16"),
}
PARTS = {
    "user": ("identifier", r"(?i)(?<![A-Z0-9_])(?:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)"
                           r"[\"']?+\x20*+[:=]\x20*+[\"']?+[A-Z0-9._@-]{3,}+"),
    "mixed": ("secret", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
                        r"[A-Za-z0-9+/_-]{20,}+={0,2}+"),
    "short": ("secret", r"(?i)(?:password|passwd|pwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+"
                        r"[^\s\"'\x01]{6,}+"),
    "endpoint": ("endpoint", r"(?i)(?:https?|s?ftp|ssh|jdbc:[a-z0-9]++|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)"
                             r"://[^\s\"'<>\x01]++"),
}
KINDS = [*BASE, *PARTS]


def _guards(text: str) -> dict:
    c = F.col(text)
    # two separate cheap tests are faster than running the pattern itself on every text
    assigned = c.contains("=") | c.contains(":")
    return {"assign": assigned, "access": c.contains("AKIA"), "hex": None, "user": assigned,
            "mixed": c.rlike("[0-9]"), "short": assigned, "endpoint": c.contains("://")}


def parts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``same`` (a digest of the text), and an array of spans for each kind."""
    out = df.select(F.col(id_col).alias("id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = out.withColumn("same", F.sha2(F.encode("text", "UTF-8"), 256))
    guard = _guards("text")
    for kind, (_, pattern, holds) in BASE.items():
        out = with_matches(out, kind, "text", pattern, guard[kind])
        out = out.withColumn(kind, F.expr(f"filter({kind}, m -> {holds.replace('(x', '(m.value')})"))
    masked = "text"
    for kind, (_, pattern, holds) in BASE.items():
        # a weak part may not lie in a base finding
        out = with_masked(out, f"_{kind}_masked", masked, pattern, holds, F.size(kind) > 0).drop(
            *([masked] if masked != "text" else []))
        masked = f"_{kind}_masked"
    guard = _guards(masked)
    for kind, (_, pattern) in PARTS.items():
        out = with_matches(out, kind, masked, pattern, guard[kind])
    return out.drop("text", masked)


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts of ``parts()`` that have a complementary part in scope: id, same, kind, start, end."""
    role = {k: v[0] for k, v in [*BASE.items(), *PARTS.items()]}
    weak = F.expr(" + ".join(f"size({k})" for k in PARTS)) > 0
    several = F.expr(" + ".join(f"size({k})" for k in KINDS)) > 1
    spans = F.concat(*[F.expr(f"transform({k}, m -> named_struct('kind', '{k}', 'role', '{role[k]}', "
                              "'start', m.start, 'end', m.end))") for k in KINDS])
    each = (found.where(weak & several).select("id", "same", spans.alias("spans")).distinct()
            .select("id", "same", F.explode("spans").alias("s")).select("id", "same", "s.*"))
    bins = (each.withColumn("bin", F.explode(F.expr(f"sequence(start div {scope}, (end - 1) div {scope})")))
            .groupBy(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("bid"), F.col("same").alias("bsame"), "bin",
                     F.col("role").alias("brole")).agg(F.min("start").alias("first"), F.max("end").alias("last")))
    asked = each.where(F.col("kind").isin(list(PARTS))).withColumn(
        "bin", F.explode(F.expr(f"sequence(greatest(start - {scope}, 0) div {scope}, (end + {scope}) div {scope})")))
    needs = ((F.col("role") == "secret") & F.col("brole").isin("identifier", "endpoint")
             | (F.col("role") != "secret") & (F.col("brole") == "secret"))
    near = (F.col("first") <= F.col("end") + scope) & (F.col("last") >= F.col("start") - scope)
    same = ((F.coalesce(F.col("id").cast("string"), F.lit("")) == F.col("bid")) & (F.col("same") == F.col("bsame"))
            & (asked["bin"] == bins["bin"]))
    return asked.join(bins, same & needs & near, "left_semi").select("id", "same", "kind", "start", "end").distinct()


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: id, ``base`` and ``spans``, arrays of (kind, start, end) by start, then kind."""
    # Written once: it is small, used three times, and a filter on the spans must not be pushed
    # below the expressions that find them.
    found = written(parts(df, id_col, text_col), "secrets")
    span = lambda k: f"transform({k}, m -> named_struct('start', m.start, 'rank', {KINDS.index(k)}, 'kind', '{k}', 'end', m.end))"
    base = F.expr(f"array_sort(concat({', '.join(span(k) for k in BASE)}))")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    linked = (link(found, scope).groupBy(F.col("id").alias("lid"), F.col("same").alias("lsame"))
              .agg(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end")).alias("linked")))
    rows = found.select("id", "same", base.alias("base"))
    return (rows.join(linked, rows["id"].eqNullSafe(linked["lid"]) & (rows["same"] == linked["lsame"]), "left")
            .select(F.col("id").alias(id_col), "base",
                    F.array_sort(F.concat("base", F.coalesce("linked", F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)")))).alias("spans")))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base findings, their digest, and all spans as text."""
    count = lambda k: F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
    return scanned.select(id_col, *[count(k) for k in BASE],
                          F.sha2(F.encode(F.expr(written_spans("base")), "UTF-8"), 256).alias("base_sha256"),
                          F.expr(written_spans("spans")).alias("spans"))

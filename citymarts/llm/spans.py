"""Positions of regular-expression matches as native expressions.

``regexp_extract_all`` gives the matches of a pattern and ``split`` the text
between them; running sums of both lengths give positions in code points. The
sums are taken in blocks, so that a text with very many matches does not copy
a growing array for each of them. Patterns must match leftmost and must not
match the empty string; write them so that they need no backtracking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 256  # matches summed at a time
SPAN = "array<struct<start:int,end:int,value:string>>"


def with_matches(df: DataFrame, out: str, text: str, pattern: str, when: Column | None = None) -> DataFrame:
    """Adds ``out``: the leftmost, non-overlapping matches of ``pattern`` in column ``text``.

    ``when`` is a cheap test that must hold wherever the pattern can match. A
    NULL text has no matches.
    """
    # A lambda must not hold the only reference to a costly column: the optimizer would move the
    # column's expression into it, to be evaluated for each element. Such columns are passed as
    # arguments or named twice.
    f, g, b, s = (f"_{out}_{x}" for x in "fgbs")
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if when is not None:
        found = F.when(when, found)
    df = df.withColumn(f, F.coalesce(found, F.array().cast("array<string>")))
    df = df.withColumn(g, F.when(F.size(f) > 0, F.transform(F.split(F.col(text), pattern, -1), F.length)))
    df = df.withColumn(g, F.expr(f"zip_with({g}, {f}, (n, x) -> named_struct('gap', n, 'len', coalesce(length(x), 0)))"))
    df = df.withColumn(b, F.expr(f"""
        if(coalesce(size({g}), 0) < 1, cast(array() as array<array<struct<gap:int,len:int>>>),
           transform(sequence(0, (size({g}) - 1) div {BLOCK}), k -> slice({g}, int(k * {BLOCK} + 1), {BLOCK})))"""))
    df = df.withColumn(s, F.expr(f"""
        aggregate({b}, named_struct('at', 0, 'all', cast(array() as array<int>)),
          (a, block) -> named_struct('at', aggregate(block, a.at, (t, x) -> t + x.gap + x.len),
                                     'all', concat(a.all, array(a.at)))).all"""))
    df = df.withColumn(b, F.expr(f"zip_with({b}, {s}, (block, at) -> named_struct('block', block, 'at', at))"))
    df = df.withColumn(s, F.expr(f"""
        flatten(transform({b}, x ->
          aggregate(x.block, named_struct('at', x.at, 'all', cast(array() as array<int>)),
            (a, y) -> named_struct('at', a.at + y.gap + y.len, 'all', concat(a.all, array(a.at + y.gap)))).all))"""))
    df = df.withColumn(out, F.expr(f"""
        filter(zip_with({f}, {s}, (x, at) -> named_struct('start', at, 'end', at + length(x), 'value', x)),
               m -> m.value is not null)"""))
    return df.drop(f, g, b, s)


def with_masked(df: DataFrame, out: str, text: str, pattern: str, only: str | None = None,
                when: Column | None = None, filler: str = "\u0001") -> DataFrame:
    """Adds ``out``: ``text`` with the matches of ``pattern`` overwritten, its length unchanged.

    ``only`` is SQL over ``x``, a match; matches for which it fails are left as they are.
    """
    f, g = f"_{out}_f", f"_{out}_g"
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    df = df.withColumn(f, F.when(when, found) if when is not None else found)
    df = df.withColumn(g, F.when(F.size(f) > 0, F.split(F.col(text), pattern, -1)))
    hidden = f"repeat('{filler}', length(x))"
    hidden = f"if({only}, {hidden}, x)" if only else hidden
    return df.withColumn(out, F.expr(f"""
        if(size({f}) > 0, array_join(zip_with({g}, {f}, (gap, x) -> concat(gap, coalesce({hidden}, ''))), ''), {text})
        """)).drop(f, g)


def written_spans(spans: str) -> str:
    """SQL: ``kind:start:end`` of each span, comma-joined; '' for none."""
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

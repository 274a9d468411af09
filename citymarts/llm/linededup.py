"""Line dedup by a log-template tree, in native expressions only.

A line is parsed at fixed depth: tokens with digits become ``<*>``, and the
number of tokens and the first ``DEPTH`` tokens lead to a leaf. In a leaf, a
position whose token is the same in more than half of the lines is constant,
any other is variable; this is the leaf's template. A line belongs to it if at
least ``SIMILAR`` of its tokens equal the template's constants; otherwise the
masked line is its own template. A template recurs if it stands in
``MIN_DOCS`` documents or, from ``PASSAGE`` tokens on, in two. Of a recurring
template's lines the first one (smallest id, then line number) stays, all
others are dropped. Lines of fewer than ``MIN_TOKENS`` tokens always stay.

Lines are compared by digests of 128 bits. Only lines in leaves with lines of
several documents are looked at further, and only those in leaves with several
different lines are taken apart into tokens, after equal lines are merged; no template's lines are ever gathered in one place.

Defined results: a NULL text stays NULL, with no lines; an empty text has one
empty line, which stays; a text that loses all lines becomes empty. Repeated
rows (same id, same text) are one document and get equal results. NULL ids
sort first. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citymarts.llm.components import written

DEPTH = 4
SIMILAR = 0.7
MIN_TOKENS = 3
MIN_DOCS = 3
PASSAGE = 20
BROADCAST_ROWS = 500_000  # leaves, members and templates (up to 40 bytes each) that are broadcast; more are joined by a shuffle


def parsed_lines(docs: DataFrame) -> DataFrame:
    """id, same, no, masked line, number of tokens and leaf of every line that counts.

    Each step is a ``transform`` of its own over a text's lines: what it makes
    is computed once, where columns upon columns would be put into one another
    and computed again for every use.
    """
    def masked(line: Column) -> Column:
        return F.when(line.rlike("[0-9]"), F.regexp_replace(
            line, r"(?<![^ \t\r\f])(?=[^ \t\r\f0-9]*+[0-9])[^ \t\r\f]++", "<*>")).otherwise(line)

    def single(line: Column) -> Column:
        # plain searches tell faster than a pattern that most lines have single blanks already
        blanks = F.lit(False)
        for c in ("  ", "\t", "\r", "\f"):
            blanks = blanks | line.contains(c)
        return F.trim(F.when(blanks, F.regexp_replace(line, r"[ \t\r\f]+", " ")).otherwise(line))

    def counted(line: Column) -> Column:
        tokens = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        return F.struct(line.alias("masked"), tokens.alias("tokens"))

    lines = F.split("text", "\n", -1)
    for step in (masked, single, counted):
        lines = F.transform(lines, step)
    rows = docs.where("text is not null").select("id", "same", F.posexplode(lines).alias("no", "l"))
    rows = rows.where(F.col("l.tokens") >= MIN_TOKENS).select("id", "same", "no", "l.masked", "l.tokens")
    return rows.withColumn("leaf", F.unhex(F.md5(F.concat_ws(" ", "tokens", F.substring_index("masked", " ", DEPTH)))))


def with_digest(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", F.unhex(F.md5("masked")))


def _held(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table as the small side of a join: broadcast up to ``most`` rows (counted), else shuffled."""
    return F.broadcast(rows) if rows.count() <= most else rows


def shared_leaves(lines: DataFrame) -> DataFrame:
    """(leaf, mixed) of the leaves with lines of several documents; mixed: with several different lines, too.

    Only these hold lines that recur: equal lines and lines of one template share their leaf.
    """
    doc, text = F.xxhash64("id", "same"), F.xxhash64("line")
    return (lines.groupBy("leaf").agg(F.min(doc).alias("a"), F.max(doc).alias("b"), F.min(text).alias("x"),
                                      F.max(text).alias("y"), F.max("tokens").alias("tokens"))
            .where("a <> b").select("leaf", F.expr(f"x <> y and tokens > {DEPTH}").alias("mixed")))


def generalised(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """(line, template) of the lines that belong to their leaf's template; others are their own."""
    variants = written(with_digest(parsed_lines(docs).join(_held(mixed), "leaf", "left_semi")).groupBy("leaf", "line")
                       .agg(F.count("*").alias("n"), F.first("masked").alias("masked")), "line-variants")
    each = variants.select("leaf", "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
    by_token = each.groupBy("leaf", "at", "token").agg(F.sum("n").alias("n"))
    by_place = by_token.groupBy("leaf", "at").agg(F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("all"))
    template = (by_place.select("leaf", "at", F.when(F.col("top.n") * 2 > F.col("all"), F.col("top.token")).alias("token"))
                .groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("template")))
    same = F.expr("aggregate(zip_with(split(masked, ' '), template, (t, c) -> if(t = c.token, 1, 0)), 0, "
                  "(a, x) -> a + coalesce(x, 0))")
    return (variants.join(template, "leaf").where(same >= SIMILAR * F.size("template"))
            .select("line", F.col("leaf").alias("template")))


def drop_recurring(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with its remaining text, and ``n_lines``, ``n_dropped``: id, text, counts.

    The result has ``id_col``, ``text_col`` and the two counts; ``remaining()`` keeps all columns.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("same", F.xxhash64("text"))
    drops = _drops(docs)
    out = docs.join(drops, docs["id"].eqNullSafe(drops["did"]) & (docs["same"] == drops["dsame"]), "left")
    return _without(out, "text").select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_lines", "n_dropped")


def remaining(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_left: float | None = None) -> DataFrame:
    """``df`` with recurring lines taken out of ``text_col``; all other columns stay as they are.

    With ``least_left``, rows that lose lines and have a smaller share of their
    characters left, or none but white space, go; rows that lose none stay.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    i, t = names[df.columns.index(id_col)], names[df.columns.index(text_col)]
    drops = _drops(rows.select(F.col(i).alias("id"), F.col(t).alias("text"), F.xxhash64(t).alias("same")))
    out = rows.join(drops, rows[i].eqNullSafe(drops["did"]) & (F.xxhash64(rows[t]) == drops["dsame"]), "left")
    out = _without(out.withColumn("_length", F.length(t)), t)
    if least_left is not None:
        out = out.where(F.col("drops").isNull() | ((F.length(t) >= F.col("_length") * least_left) & F.col(t).rlike(r"\S")))
    return out.select(*names).toDF(*df.columns)


def _drops(docs: DataFrame) -> DataFrame:
    """did, dsame, drops: the numbers of the lines that go, per document that loses any."""
    lines = written(with_digest(parsed_lines(docs)).drop("masked"), "lines")
    leaves = written(shared_leaves(lines), "shared-leaves")
    own = written(generalised(docs, leaves.where("mixed").select("leaf")).withColumnRenamed("line", "member"), "members")
    lines = lines.join(_held(leaves.select("leaf")), "leaf", "left_semi")
    own = _held(own)
    lines = written(lines.join(own, lines["line"] == own["member"], "left").select(
        "id", "same", "no", "tokens", F.coalesce("template", "line").alias("template")), "shared-lines")
    first = lines.groupBy("template", "id", "same").agg(F.min("no").alias("no"), F.first("tokens").alias("tokens"))
    recurring = (first.groupBy(F.col("template").alias("t"))
                 .agg(F.count("*").alias("docs"), F.min(F.struct("id", "same", "no")).alias("kept"), F.max("tokens").alias("n"))
                 .where(f"docs >= {MIN_DOCS} or docs >= 2 and n >= {PASSAGE}").select("t", "kept"))
    recurring = _held(written(recurring, "recurring"))     # broadcast, a template in very many documents is no hot key
    gone = lines.join(recurring, lines["template"] == recurring["t"]).where(~F.struct("id", "same", "no").eqNullSafe(F.col("kept")))
    return gone.groupBy(F.col("id").alias("did"), F.col("same").alias("dsame")).agg(F.collect_set("no").alias("drops"))


def _without(rows: DataFrame, text: str) -> DataFrame:
    every = F.split(text, "\n", -1)
    left = F.expr(f"array_except(sequence(0, size(split({text}, '\\n', -1)) - 1), drops)")
    rows = rows.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(every)).cast("long"))
    rows = rows.withColumn("n_dropped", F.coalesce(F.when(F.col("drops").isNotNull(), F.size("drops")), F.lit(0)).cast("long"))
    # the lines are named twice, so that they are split once and not for each line
    rows = rows.withColumn("_lines", F.when(F.col("drops").isNotNull(), every)).withColumn("_left", left)
    return rows.withColumn(text, F.expr(f"if(_lines is null, {text}, array_join(transform(_left, i -> _lines[i]), '\\n'))"))


#: DuckDB SQL for ``drop_recurring`` on ``documents``.
SQL = f"""
    WITH l AS (SELECT doc_id, text, unnest(range(len(s))) AS no, unnest(s) AS line
               FROM (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS s FROM documents)),
         t AS (SELECT doc_id, text, no, list_transform(list_filter(regexp_split_to_array(line, '[ \\t\\r\\f]+'), lambda x: x <> ''),
                      lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w FROM l),
         k AS (SELECT *, len(w) AS n, array_to_string(w, ' ') AS line,
                      array_to_string([len(w)::VARCHAR] || w[1:{DEPTH}], ' ') AS leaf FROM t WHERE len(w) >= {MIN_TOKENS}),
         m AS (SELECT leaf FROM k GROUP BY leaf
               HAVING count(DISTINCT (doc_id, text)) > 1 AND count(DISTINCT line) > 1 AND max(n) > {DEPTH}),
         p AS (SELECT leaf, pos, token, count(*) AS c FROM (
                 SELECT leaf, unnest(range(n)) AS pos, unnest(w) AS token FROM k SEMI JOIN m USING (leaf)) GROUP BY ALL),
         c AS (SELECT leaf, pos, token FROM p QUALIFY 2 * c > sum(c) OVER (PARTITION BY leaf, pos)),
         v AS (SELECT DISTINCT leaf, line, n, w FROM k SEMI JOIN m USING (leaf)),
         s AS (SELECT v.line, any_value(v.leaf) AS leaf FROM (
                 SELECT leaf, line, n, unnest(range(n)) AS pos, unnest(w) AS token FROM v) v
               JOIN c ON c.leaf = v.leaf AND c.pos = v.pos AND c.token = v.token
               GROUP BY v.line HAVING count(*) >= {SIMILAR} * any_value(v.n)),
         r AS (SELECT k.doc_id, k.text, k.no, k.n, CASE WHEN s.leaf IS NOT NULL THEN 'leaf ' || s.leaf ELSE 'line ' || k.line END AS tpl
               FROM k LEFT JOIN s ON k.line = s.line),
         q AS (SELECT tpl FROM r GROUP BY tpl HAVING count(DISTINCT (doc_id, text)) >= {MIN_DOCS}
               OR count(DISTINCT (doc_id, text)) >= 2 AND max(n) >= {PASSAGE}),
         g AS (SELECT doc_id, text, no FROM r SEMI JOIN q USING (tpl)
               QUALIFY row_number() OVER (PARTITION BY tpl ORDER BY doc_id, no) > 1),
         o AS (SELECT l.doc_id, l.text, string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE g.no IS NULL) AS rest,
                      count(*) AS n_lines, count(g.no) AS n_dropped
               FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.text = g.text AND l.no = g.no GROUP BY ALL)
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.rest, '') END AS text,
           coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_dropped, 0) AS n_dropped
    FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id AND d.text = o.text"""

"""Information-theoretic sanitisation of personal data, in native expressions only.

Base findings (email addresses, IP addresses, card and phone numbers) are the
protected entities. For every term near an entity the corpus tells how much of
the entity's information content the term reveals:

    disclosure(t, e) = PMI(t; e) / IC(e)
                     = log(n(t, e) N / (n(t) n(e))) / log(N / n(e))

with N documents, n(e) documents that hold the entity, n(t) documents that
hold the term, and n(t, e) documents that hold both; 1 means that the term
gives the entity away. From ``GENERALISE`` on a term is replaced by a general
word, from ``REMOVE`` on it is removed, wherever it stands in any document. All
counts cover all documents.

That is ``scan(everywhere=True)``, as in the registered query. A term is judged
if its disclosure still reaches ``GENERALISE`` with n(t, e) / n(t) replaced by
its Wilson lower bound (one-sided, ``Z``), so an entity of one document is
judged where the corpus is large enough (N / n(e) from about 190 on). Without
``everywhere``, n(t, e) counts the documents where the term stands within
``CONTEXT`` characters of the entity, pairs of ``SUPPORT`` documents are judged,
and only the terms in these windows are replaced.

Terms are words of three or more letters in lower case, outside of email
addresses. Windows end at email addresses, and a word cut by the window's end
is not a term.

Defined results: a NULL text is an empty one and has no findings; a NULL id is
kept; repeated rows give repeated results and count as one document; an empty
table gives an empty result. Other columns are not read. Positions are code
points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citymarts.llm.components import written
from citymarts.llm.spans import with_masked, with_matches, written_spans

CONTEXT = 60
SUPPORT = 3
GENERALISE, REMOVE = 0.75, 0.95
Z = 1.645            # one-sided 95 %

_DIGITS = "regexp_replace(x, '[^0-9]', '')"
#: kind: (pattern, SQL over the match ``x`` that it must satisfy). Possessive quantifiers and the conditions
#: on the character before keep the leftmost match and need no backtracking on any text.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
           "forall(split(x, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)"),
    "card": (r"[0-9](?:[\x20-]?+[0-9])++",
             f"""length({_DIGITS}) between 13 and 19 and
                 aggregate(transform(split(reverse({_DIGITS}), ''), (c, i) ->
                   if(i % 2 = 0, int(c), if(int(c) > 4, 2 * int(c) - 9, 2 * int(c)))), 0, (a, d) -> a + coalesce(d, 0)) % 10 = 0"""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15"),
}
WORD = r"\p{L}{3,}+"
TERM = "term"


def _cheap(text: str) -> dict:
    c = F.col(text)
    return {"email": c.contains("@"), "ip": c.rlike("[0-9][.][0-9]"), "card": c.rlike("[0-9][ -]?[0-9]"),
            "phone": c.contains("+")}


def _valid(kind: str, array: str) -> str:
    return f"filter({array}, m -> exists(array(m.value), x -> {BASE[kind][1]}))"


def base_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``same`` (a digest of the text), spans per kind, and the text where there are any."""
    out = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = out.withColumn("same", F.sha2(F.encode("text", "UTF-8"), 256))
    cheap = _cheap("text")
    for kind, (pattern, _) in BASE.items():
        out = with_matches(out, kind, "text", pattern, cheap[kind])
        out = out.withColumn(kind, F.expr(_valid(kind, kind)))
    any_found = F.expr(" + ".join(f"size({k})" for k in BASE)) > 0
    return out.select("id", "same", *BASE, F.when(any_found, F.col("text")).alias("text"))


def contexts(found: DataFrame, around: int = CONTEXT) -> DataFrame:
    """The terms near each entity: id, same, entity, term, start, end (of the term)."""
    docs = found.where("text is not null").dropDuplicates(["id", "same"]).select("id", "same", "text")
    # without the addresses, no window can run into one
    docs = with_masked(docs, "plain", "text", BASE["email"][0], when=F.col("text").contains("@"))
    docs = written(docs, "pii-contexts")
    sides = []
    for kind, (pattern, holds) in BASE.items():
        source = "text" if kind == "email" else "plain"
        each = with_matches(docs, "m", source, pattern, _cheap(source)[kind])
        # an email's neighbours are looked up where all addresses are masked, too
        each = each.select("id", "same", "plain", F.expr(f"inline({_valid(kind, 'm')})"))
        name = F.lower("value") if kind == "email" else F.regexp_replace("value", "[^0-9.]" if kind == "ip" else "[^0-9]", "")
        sides.append(each.select("id", "same", F.concat(F.lit(f"{kind}:"), name).alias("entity"),
                                 F.struct(F.greatest(F.col("start") - around, F.lit(0)).alias("from"),
                                          F.col("start").alias("to")).alias("left"),
                                 F.struct(F.col("end").alias("from"), (F.col("end") + around).alias("to")).alias("right")))
    entities = sides[0]
    for side in sides[1:]:
        entities = entities.unionByName(side)
    windows = entities.select("id", "same", "entity", F.explode(F.array("left", "right")).alias("w")).select(
        "id", "same", "entity", "w.from", "w.to").where("from < to").distinct()
    # windows and words meet in bins of the window's length
    words = with_matches(docs, "w", "plain", WORD).select("id", "same", F.expr("inline(w)"))
    words = words.withColumn("bin", F.expr(f"start div {around}"))
    windows = windows.withColumn("bin", F.explode(F.expr(f"sequence(from div {around}, to div {around})")))
    inside = (F.col("start") >= F.col("from")) & (F.col("end") <= F.col("to"))
    key = words["id"].eqNullSafe(windows["id"]) & (words["same"] == windows["same"]) & (words["bin"] == windows["bin"])
    return words.join(windows, key & inside).select(
        words["id"], words["same"], "entity", F.lower("value").alias("term"), "start", "end").distinct()


def disclosures(near: DataFrame, docs: DataFrame, text_col: str = "text", support: int = SUPPORT,
                least: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of at least ``least``, of terms near an entity in ``support`` documents or more.

    ``near`` has the terms of ``contexts()``; ``docs`` are all documents. A
    term stands in at least as many documents as it stands near entities in.
    Pairs that this number rules out are left out before the term's documents
    are counted, so common words are not.
    """
    part = lambda n_t: F.log(F.col("n_te") * F.col("n") / (F.col(n_t) * F.col("n_e"))) / F.log(F.col("n") / F.col("n_e"))
    by_doc = near.select("term", "id", "same").distinct().groupBy("term").agg(F.count("*").alias("at_least"))
    pairs = (near.select("entity", "term", "id", "same").distinct().groupBy("entity", "term")
             .agg(F.count("*").alias("n_te")))
    of_entity = near.select("entity", "id", "same").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    total = docs.select(F.count("*").alias("n"))
    judged = (pairs.where(F.col("n_te") >= support).join(of_entity, "entity").join(by_doc, "term")
              .crossJoin(F.broadcast(total)))  # one row
    judged = written(judged.where((F.col("n") > F.col("n_e")) & (part("at_least") >= least)), "pii-pairs")
    words = WORD.replace("\\", "\\\\")
    texts = docs.select(F.expr(f"explode(array_distinct(regexp_extract_all(lower({text_col}), '{words}', 0)))").alias("term"))
    of_term = (texts.join(judged.select("term").distinct(), "term", "left_semi")
               .groupBy("term").agg(F.count("*").alias("n_t")))
    return (judged.join(of_term, "term").select("entity", "term", part("n_t").alias("disclosure"))
            .where(F.col("disclosure") >= least))


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc (a key of id and text), text, and ``plain``, the text without email addresses."""
    out = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = out.select(F.xxhash64("id", F.sha2(F.encode("text", "UTF-8"), 256)).alias("doc"), "text")
    return with_masked(out, "plain", "text", BASE["email"][0], when=F.col("text").contains("@"))


def _terms(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and each distinct term of ``plain``."""
    words = WORD.replace("\\", "\\\\")
    each = f"explode(array_distinct(transform(regexp_extract_all(plain, '{words}', 0), x -> lower(x))))"
    return docs.select(*columns, F.expr(each).alias("term"))


def lower_bound(k: str, n: str) -> str:
    """SQL: Wilson's lower bound of the share ``k`` of ``n``."""
    return (f"(({k}) / ({n}) + {Z * Z / 2} / ({n}) - {Z} * sqrt(({k}) / ({n}) * (1 - ({k}) / ({n})) / ({n})"
            f" + {Z * Z / 4} / ({n}) / ({n}))) / (1 + {Z * Z} / ({n}))")


def judgements(found: DataFrame, docs: DataFrame, least: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of at least ``least``, counted over whole documents.

    ``found`` has the spans of ``base_spans()``, ``docs`` the rows of
    ``_documents()``. A pair stands in min(n(t), n(e)) documents at most; pairs
    that this bound rules out are left out before they are counted.
    """
    name = {"email": "lower(m.value)", "ip": "regexp_replace(m.value, '[^0-9.]', '')"}
    names = [f"transform({k}, m -> concat('{k}:', {name.get(k, "regexp_replace(m.value, '[^0-9]', '')")}))" for k in BASE]
    key = F.xxhash64("id", "same").alias("doc")
    # repeated rows are one document: each counts as its share
    rows = found.groupBy(key).agg(F.count("*").alias("rows"))
    repeated = written(rows.where("rows > 1"), "pii-repeated")
    holding = written(found.where("text is not null").select(key, F.expr(f"explode(array_distinct(concat({', '.join(names)})))")
                                                             .alias("entity")).distinct(), "pii-entities")
    of_entity = holding.groupBy("entity").agg(F.count("*").alias("n_e"))
    total = rows.select(F.count("*").alias("n"))
    share = F.lit(1.0) / F.coalesce("rows", F.lit(1))
    of_term = (_terms(docs.select("doc", "plain").join(repeated, "doc", "left"), share.alias("share"))
               .groupBy("term").agg(F.round(F.sum("share")).cast("long").alias("n_t")))
    of_entity = written(of_entity.crossJoin(F.broadcast(total)).where("n > n_e"), "pii-entity-counts")  # one row
    reach = lambda k: f"ln({lower_bound(k, 'n_t')} * n / n_e) / ln(n / n_e) >= {least}"
    # the most frequent term that the most frequent entity could still judge
    most = of_entity.select(F.max(F.expr(f"pow(n, 1 - {least}) * pow(n_e, {least})")).alias("most"))
    rare = of_term.crossJoin(F.broadcast(most)).where("n_t <= most").drop("most")
    texts = _documents(found.where("text is not null").dropDuplicates(["id", "same"]), "id", "text")
    near = written(_terms(texts, "doc").join(rare, "term"), "pii-terms")
    pairs = (near.join(holding.join(of_entity, "entity"), "doc").where(reach("least(n_t, n_e)"))
             .groupBy("entity", "term", "n_e", "n_t", "n").agg(F.count("*").alias("n_te")))
    return (pairs.where(reach("n_te"))
            .select("entity", "term", F.expr("ln(n_te * n / (n_t * n_e)) / ln(n / n_e)").alias("disclosure"))
            .where(F.col("disclosure") >= least))


def occurrences(docs: DataFrame, judged: DataFrame, remove: float = REMOVE) -> DataFrame:
    """Per document that holds a judged term: doc, text, ``terms``: the spans of all judged terms."""
    flagged = written(judged.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii-judged")
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    actions = (_terms(docs, "doc").join(flagged, "term").groupBy("doc")
               .agg(F.map_from_entries(F.collect_set(F.struct("term", action.alias("action")))).alias("actions")))
    held = docs.join(written(actions, "pii-actions"), "doc").dropDuplicates(["doc"])
    held = with_matches(held, "w", "plain", WORD)
    return held.select("doc", "text", F.expr(f"""
        array_sort(transform(filter(w, m -> map_contains_key(actions, lower(m.value))), m ->
          named_struct('start', m.start, 'kind', '{TERM}', 'end', m.end, 'action', actions[lower(m.value)])))""").alias("terms"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
         generalise: float = GENERALISE, remove: float = REMOVE, with_text: bool = False, everywhere: bool = False) -> DataFrame:
    """Per row: id, ``base`` and ``spans``: arrays of (kind, start, end, action) by kind, then start.

    With ``with_text``, ``text`` is the original where there is any span. With
    ``everywhere``, whole documents are counted (``support`` is not read) and a
    judged term is found in all texts.
    """
    found = written(base_spans(df, id_col, text_col), "pii")
    span = lambda k: f"transform({k}, m -> named_struct('start', m.start, 'kind', '{k}', 'end', m.end, 'action', 'remove'))"
    none = F.expr("cast(array() as array<struct<start:int,kind:string,end:int,action:string>>)")
    if everywhere:
        docs = _documents(df, id_col, text_col)
        terms = occurrences(docs, judgements(found, docs, least=generalise), remove)
        terms = terms.select("doc", F.col("text").alias("term_text"), "terms") if with_text else terms.select("doc", "terms")
        rows = found.select(F.xxhash64("id", "same").alias("doc"), "id", "text",
                            F.expr(f"concat({', '.join(span(k) for k in BASE)})").alias("base"))
        return (rows.join(terms, "doc", "left")
                .select(F.col("id").alias(id_col), "base", F.concat("base", F.coalesce("terms", none)).alias("spans"),
                        *([F.coalesce("text", "term_text").alias("text")] if with_text else [])))
    docs = df.select(F.col(text_col).cast("string").alias("text"))
    near = written(contexts(found), "pii-near")
    judged = disclosures(near, docs, support=support, least=generalise)
    terms = (near.join(judged, ["entity", "term"]).groupBy("id", "same", "start", "end")
             .agg(F.max("disclosure").alias("disclosure"))
             .groupBy(F.col("id").alias("tid"), F.col("same").alias("tsame"))
             .agg(F.array_sort(F.collect_list(F.struct(
                 "start", F.lit(TERM).alias("kind"), "end",
                 F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise").alias("action")))).alias("terms")))
    rows = found.select("id", "same", "text", F.expr(f"concat({', '.join(span(k) for k in BASE)})").alias("base"))
    return (rows.join(terms, rows["id"].eqNullSafe(terms["tid"]) & (rows["same"] == terms["tsame"]), "left")
            .select(F.col("id").alias(id_col), "base", F.concat("base", F.coalesce("terms", none)).alias("spans"),
                    *(["text"] if with_text else [])))


def sanitise(scanned: DataFrame) -> DataFrame:
    """Replaces ``text`` of ``scan(with_text=True)``: entities by their kind, terms by [TERM] or nothing.

    Spans that overlap an earlier one are covered by its replacement and by their own rest.
    """
    ordered = "array_sort(transform(spans, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind, 'action', s.action)))"
    done = f"""aggregate({ordered}, named_struct('at', 0, 'out', ''),
        (a, s) -> named_struct('at', greatest(a.at, s.end), 'out',
            concat(a.out, if(s.start > a.at, substring(text, a.at + 1, s.start - a.at), ''),
                   if(s.end <= a.at, '', if(s.kind = '{TERM}', if(s.action = 'remove', '', '[TERM]'),
                                            concat('[', upper(s.kind), ']'))))),
        a -> concat(a.out, substring(text, a.at + 1, length(text))))"""
    return scanned.withColumn("text", F.expr(f"if(text is null, null, {done})"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base findings, their digest, and all spans as text."""
    count = lambda k: F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
    return scanned.select(id_col, *[count(k) for k in BASE],
                          F.sha2(F.encode(F.expr(written_spans("base")), "UTF-8"), 256).alias("base_sha256"),
                          F.expr(written_spans("spans")).alias("spans"))

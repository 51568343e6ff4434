"""Personal data: base patterns and information-theoretic sanitisation.

Only DataFrame and SQL functions are used.

Base spans are the leftmost non-overlapping matches of four patterns, kept if
their digits are valid.  Positions are code points: a text is split by its
matches, and the lengths of parts and matches are summed.

The protected entities are the values of the base spans.  A term is a word of
three letters or more outside email addresses; it co-occurs with an entity when
both are in one document.  Over all documents,

    PMI(t, e) = ln(N * n(t, e) / (n(t) * n(e))),    IC(e) = ln(N / n(e)),

with n counting documents.  PMI / IC is the share of the entity's information
that the term gives away: 1 if the term never occurs without it.  Terms seen
with the entity in ``min_support`` documents or more are generalised from
``generalise`` on and removed from ``remove`` on, wherever they stand in the
documents of that entity.

Null text is empty and has no spans.  A row's spans depend on its text alone,
apart from the corpus counts, where each row is a document: repeated rows
count again.  No documents give no rows.  Columns of the input other than
doc_id and text are not read, and ``sanitise`` passes them through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize, text_or_empty, with_own_names

KINDS = ("email", "ip", "card", "phone", "term")
#: Candidate terms beyond this many are joined by a shuffle, not broadcast.
BROADCAST_TERMS = 100_000

# Written so that a match is tried once per run of characters and never
# backtracks, in time linear in the text.  \G lets a match begin where the one
# before it ended.
_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9])++",
}
#: A cheap test that a text can hold a valid match at all.
_POSSIBLE = {
    "email": "contains(text, '@')",
    "ip": r"text rlike r'[0-9]\.[0-9]++\.[0-9]'",
    "card": r"text rlike r'[0-9](?:[ -]?[0-9]){13}'",
    "phone": "contains(text, '+')",
}
_VALID = {
    "email": "true",
    "ip": r"forall(split(x.v, r'\.'), p -> length(trim(LEADING '0' FROM p)) < 3"
          r" or (length(trim(LEADING '0' FROM p)) = 3 and trim(LEADING '0' FROM p) <= '255'))",
    "card": """length(regexp_replace(x.v, '[ -]', '')) between 14 and 19 and
        aggregate(sequence(1, 20), 0, (total, i) -> total + if(i % 2 = 0, 1, 2)
            * int(substr(lpad(regexp_replace(x.v, '[ -]', ''), 20, '0'), i, 1))
            - if(i % 2 = 1 and substr(lpad(regexp_replace(x.v, '[ -]', ''), 20, '0'), i, 1) > '4', 9, 0)) % 10 = 0""",
    "phone": "length(regexp_replace(x.v, '[^0-9]', '')) between 10 and 15",
}


def _located(text: str, pattern: str) -> str:
    """SQL: the matches of a pattern as array<struct<s, e, v>>, in order."""
    return f"""aggregate(
        zip_with(split({text}, r'{pattern}', -1), regexp_extract_all({text}, r'{pattern}', 0), (p, h) -> struct(p, h)),
        named_struct('at', 0, 'found', cast(array() as array<struct<s:int,e:int,v:string>>)),
        (a, x) -> named_struct('at', a.at + length(x.p) + coalesce(length(x.h), 0), 'found', if(x.h is null, a.found,
            concat(a.found, array(named_struct('s', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.h), 'v', x.h))))),
        a -> a.found)"""


_NONE = "cast(array() as array<struct<s:int,k:int,e:int,v:string>>)"


def _base(kind: str) -> str:
    k = KINDS.index(kind)
    return f"""if({_POSSIBLE[kind]}, transform(filter({_located('text', _PATTERNS[kind])}, x -> {_VALID[kind]}),
        x -> named_struct('s', x.s, 'k', {k}, 'e', x.e, 'v', x.v)), {_NONE})"""


def base_spans(docs: DataFrame) -> DataFrame:
    """The documents with ``base``: array of (s, k, e, v), begin, kind index,
    end and value, by begin and kind.  Null text becomes empty."""
    return (docs.withColumn("text", text_or_empty())
            .withColumn("base", F.expr("array_sort(concat(" + ", ".join(map(_base, _PATTERNS)) + "))")))


_WORD = r"\p{L}{3,}+"


def _words() -> str:
    """SQL: the document's different terms."""
    return f"""array_distinct(transform(regexp_extract_all(
        if({_POSSIBLE['email']}, regexp_replace(text, r'{_PATTERNS['email']}', ' '), text), r'{_WORD}', 0), w -> lower(w)))"""


def _disclosing(near: DataFrame, entities: DataFrame, min_support: int, generalise: float) -> DataFrame:
    """(term, entity, share) of the pairs above the threshold; entities: (row,
    entity), once each."""
    n_e = entities.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= min_support)
    n_e = materialize(n_e, "entities")
    pairs = (entities.join(n_e, "entity", "left_semi").join(near.where(F.size("base") > 0).select("row", "words"), "row")
             .select("entity", F.explode("words").alias("term"))
             .groupBy("term", "entity").agg(F.count("*").alias("both"))
             .where(F.col("both") >= min_support))
    pairs = materialize(pairs, "pairs")
    terms = pairs.select("term").distinct()
    if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    seen = (near.select(F.explode("words").alias("term")).join(terms, "term", "left_semi")
            .groupBy("term").agg(F.count("*").alias("n_t")))
    total = near.agg(F.count("*").alias("n"))
    pmi = F.ln(F.col("n") * F.col("both") / (F.col("n_t") * F.col("n_e")))
    information = F.ln(F.col("n") / F.col("n_e"))
    return (pairs.join(n_e, "entity").join(seen, "term").crossJoin(F.broadcast(total))  # one row
            .withColumn("share", F.when(information > 0, pmi / information))
            .where(F.col("share") >= generalise).select("term", "entity", "share"))


def _occurrences() -> str:
    """SQL: every place of the terms of map ``shares`` that overlaps no base
    span, as array<struct<s, e, share>>."""
    return f"""transform(filter({_located('text', '{}').replace("r'{}'", 'pattern')},
        t -> not exists(base, b -> b.s < t.e and t.s < b.e)),
        t -> named_struct('s', t.s, 'e', t.e, 'share', element_at(shares, lower(t.v))))"""


def find(docs: DataFrame, min_support: int = 3, generalise: float = 0.8) -> DataFrame:
    """One row per document: doc_id, ``key`` (hash of its text), ``base`` and
    ``terms`` (array of (s, e, share)), without the text."""
    near = base_spans(docs.select("doc_id", "text"))
    near = (near.withColumns({"row": F.monotonically_increasing_id(), "words": F.expr(_words()),
                              "key": F.xxhash64("text")})
            .withColumn("text", F.when(F.size("base") > 0, F.col("text"))))
    near = materialize(near.select("row", "doc_id", "key", "base", "words", "text"), "near")
    values = F.array_distinct(F.transform("base", lambda b: b["v"]))
    entities = near.where(F.size("base") > 0).select("row", F.explode(values).alias("entity"))
    pairs = materialize(_disclosing(near, entities, min_support, generalise), "disclosing")
    shares = (entities.join(pairs, "entity").groupBy("row", "term").agg(F.max("share").alias("share"))
              .groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares")))
    # The forms the document has: upper case is no matter of the pattern.
    forms = f"filter(array_distinct(regexp_extract_all(text, r'{_WORD}', 0)), w -> map_contains_key(shares, lower(w)))"
    terms = (near.select("row", "base", "text").join(shares, "row")
             .withColumn("forms", F.expr(forms)).where(F.size("forms") > 0)
             .withColumn("pattern", F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join("forms", "|"), F.lit(r")(?!\p{L})")))
             .select("row", F.expr(_occurrences()).alias("terms")))
    return near.select("row", "doc_id", "key", "base").join(terms, "row", "left").select(
        "doc_id", "key", "base", F.coalesce("terms", F.expr("cast(array() as array<struct<s:int,e:int,share:double>>)"))
        .alias("terms"))


def _all_spans() -> str:
    return f"""array_sort(concat(transform(base, b -> struct(b.s, b.k, b.e)),
        transform(terms, t -> named_struct('s', t.s, 'k', {KINDS.index('term')}, 'e', t.e))))"""


def _listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', array({names})[x.k], x.s, x.e)), ',')"


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and the list of all."""
    count = {f"n_{kind}": F.expr(f"cast(size(filter(base, b -> b.k = {i})) as bigint)")
             for i, kind in enumerate(KINDS[:4])}
    return found.select("doc_id", *(c.alias(n) for n, c in count.items()),
                        F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"),
                        F.expr(_listed(_all_spans())).alias("spans"))


def sanitise(docs: DataFrame, min_support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """The documents with base spans replaced by their kind, disclosing terms
    by [TERM] or nothing.  Overlapping spans are replaced as one, named after
    the first.  ``n_chars`` follows where it is a column.  All other columns
    come back as they were, whatever their names."""
    return with_own_names(docs, ("_key", "_m", "_d", "_k"),
                          lambda own: _sanitise(own, min_support, generalise, remove))


def _sanitise(docs: DataFrame, min_support: int, generalise: float, remove: float) -> DataFrame:
    labels = ", ".join(f"'[{k.upper()}]'" for k in KINDS[:4])
    marks = f"""array_sort(concat(transform(base, b -> named_struct('s', b.s, 'e', b.e, 'l', array({labels})[b.k])),
        transform(terms, t -> named_struct('s', t.s, 'e', t.e, 'l', if(t.share >= {remove}, '', '[TERM]')))))"""
    merged = f"""aggregate({marks}, cast(array() as array<struct<s:int,e:int,l:string>>), (a, x) -> if(
        size(a) > 0 and x.s < element_at(a, -1).e,
        concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s,
            'e', greatest(element_at(a, -1).e, x.e), 'l', element_at(a, -1).l))),
        concat(a, array(x))))"""
    rebuilt = """concat(array_join(transform(_m, (x, i) -> concat(
        substr(text, if(i = 0, 0, _m[i - 1].e) + 1, x.s - if(i = 0, 0, _m[i - 1].e)), x.l)), ''),
        substr(text, element_at(_m, -1).e + 1))"""
    found = find(docs, min_support, generalise).where("size(base) > 0").withColumn("_m", F.expr(merged))
    found = found.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "_m").distinct()
    own = docs.alias("o").withColumn("_key", F.xxhash64(text_or_empty()))
    out = own.join(found, own["doc_id"].eqNullSafe(found["_d"]) & (own["_key"] == found["_k"]), "left")
    changed = F.col("_m").isNotNull()
    out = out.withColumn("text", F.when(changed, F.expr(rebuilt)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

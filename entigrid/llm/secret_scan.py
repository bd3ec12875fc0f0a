"""Secret scan with a trigram inverted index, in DataFrame functions only.

From each rule's pattern follows a Boolean query over trigrams (``trigrams.py``). An index holds,
for each trigram of these queries, the documents that have it; a rule's query is answered by
intersecting and uniting its postings, and only the documents found are read with the pattern. A
rule without mandatory trigrams (long hexadecimal numbers) reads all documents.

A rule takes its leftmost matches that don't overlap, then drops those that are too short. Spans
of different rules may overlap. Offsets are code points, ends exclusive. Defined results: null is
the empty text; a document without secrets has no spans; rows that repeat are rows of their own.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.llm.common import free_name, small, stored, text_of
from entigrid.llm.trigrams import Query, trigram_query, trigrams


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: the group whose length counts, and its least length
    group: int
    least: int


# The patterns of the base rules, then those of four well-known token formats.
RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
]
BASE = ("assign", "access", "hex")
REDACTED = "[REDACTED]"


def _quick(rule: Rule) -> str:
    """A pattern for "has a match that is long enough": the same for patterns whose last class
    takes all it can, with the length put into the count."""
    if rule.kind == "hex":
        return f"[0-9a-f]{{{rule.least},}}"
    return rule.pattern


# Trigrams whose postings one 64-bit number unites.
_WORD = 60


def _present(query: Query, number: dict[str, int]) -> Column:
    """The query over the sets of bits of a document's trigrams."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.getbit(F.col(f"bits{number[query] // _WORD}"), F.lit(number[query] % _WORD)) == 1
    parts = [_present(q, number) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def trigram_index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, mark): the documents that have each of the wanted trigrams, by
    id and a hash of the text."""
    low = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.lower("text").alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(wanted)]))
    return low.select("doc_id", "mark", F.explode(has).alias("trigram"))


def candidates(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, mark, rules): by the index, which rules can match which documents; documents
    that no rule's query finds have no row."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted({t for q in queries for t in trigrams(q)})
    number = {t: i for i, t in enumerate(wanted)}
    bits = [
        F.expr(f"bit_or(IF(trigram DIV {_WORD} = {w}, shiftleft(1L, trigram % {_WORD}), 0L)) AS bits{w}")
        for w in range(len(wanted) // _WORD + 1)
    ]
    met = trigram_index(docs, wanted).groupBy("doc_id", "mark").agg(*bits)
    found = F.lit(0)
    for i, q in enumerate(queries):
        if q is not True:
            found = found.bitwiseOR(F.when(_present(q, number), F.lit(1 << i)).otherwise(F.lit(0)))
    return met.select("doc_id", "mark", found.alias("rules")).filter("rules != 0")


def _matches(rule: Rule, text: str) -> Column:
    """The rule's spans as structs (start, rank, end, kind)."""
    quoted = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
    rank = [r.kind for r in RULES].index(rule.kind)
    long_enough = f"length(x.g) >= {rule.least}"
    return F.expr(
        f"""aggregate(
          transform(
            arrays_zip(slice(split({text}, '{quoted}', -1), 1, size(regexp_extract_all({text}, '{quoted}', 0))),
                       regexp_extract_all({text}, '{quoted}', 0), regexp_extract_all({text}, '{quoted}', {rule.group})),
            x -> named_struct('b', x['0'], 'm', x['1'], 'g', x['2'])),
          named_struct('at', 0, 'out', CAST(array() AS array<struct<start:int,rank:int,end:int,kind:string>>)),
          (s, x) -> named_struct(
            'at', s.at + length(x.b) + length(x.m),
            'out', IF({long_enough},
              concat(s.out, array(named_struct('start', s.at + length(x.b), 'rank', {rank}, 'end', s.at + length(x.b) + length(x.m), 'kind', '{rule.kind}'))),
              s.out)),
          s -> s.out)"""
    )


def with_secrets(docs: DataFrame, spans: str, rules: list[Rule] = RULES) -> DataFrame:
    """The documents with an array column ``spans`` of structs (start, rank, end, kind), by start,
    then rule. ``docs`` needs doc_id and text."""
    text, mark, own, other = (free_name(docs, n) for n in ("body", "mark", "found_id", "found_mark"))
    can = free_name(docs, "rules")
    found = stored(
        candidates(docs.select("doc_id", text_of().alias("text")), rules)
        .select(F.col("doc_id").alias(own), F.col("mark").alias(other), F.col("rules").alias(can)),
        "candidates",
    )
    marked = docs.withColumn(text, text_of()).withColumn(mark, F.xxhash64(text))
    same = marked["doc_id"].eqNullSafe(F.col(own)) & (F.col(mark) == F.col(other))
    joined = marked.join(small(found), same, "left").drop(own, other, mark)
    nothing = F.expr("CAST(array() AS array<struct<start:int,rank:int,end:int,kind:string>>)")
    parts = []
    for i, rule in enumerate(rules):
        if trigram_query(rule.pattern) is True:
            test = F.col(text).rlike(_quick(rule))
        else:
            test = F.coalesce(F.col(can).bitwiseAND(1 << i) != 0, F.lit(False))
        parts.append(F.when(test, _matches(rule, f"`{text}`")).otherwise(nothing))
    return joined.withColumn(spans, F.array_sort(F.concat(*parts))).drop(text, can)


def spans_text(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """The spans as kind:start:end, comma-joined."""
    only = "" if kinds is None else f"x.kind IN ({', '.join(repr(k) for k in kinds)})"
    source = f"`{spans}`" if kinds is None else f"filter(`{spans}`, x -> {only})"
    return F.expr(f"array_join(transform({source}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def redacted(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The documents, same columns, with every stretch of spans replaced by ``[REDACTED]`` (and
    ``n_chars``, where there is such a column, counted again for those). None is dropped."""
    spans, hit = free_name(docs, "spans"), free_name(docs, "hit")
    found = with_secrets(docs, spans, rules).withColumn(hit, F.size(spans) > 0)
    built = F.expr(
        f"""aggregate(`{spans}`, named_struct('at', 0, 'out', ''),
          (s, x) -> CASE WHEN x.start >= s.at
            THEN named_struct('at', x.end, 'out', concat(s.out, substr(text, s.at + 1, x.start - s.at), '{REDACTED}'))
            ELSE named_struct('at', greatest(s.at, x.end), 'out', s.out) END,
          s -> concat(s.out, substr(text, s.at + 1)))"""
    )
    out = found.withColumn("text", F.when(F.col(hit), built).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        again = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(hit), again).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

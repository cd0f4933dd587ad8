"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regex yields a Boolean query of trigrams that any match must contain: a disjunction of conjunctions. Of a
literal the query takes every third trigram and the last, which together cover it. The index holds, for the trigrams that
some query asks for, the ids of the texts whose lower case contains them. Postings are intersected by counting, for each text and conjunction, the distinct trigrams found; texts that satisfy a rule's query
are its candidates, and only these are verified with the regex itself. A rule without a mandatory trigram is
tried on every text.

Verification cuts a text at the regex's leftmost non-overlapping matches; the running sum of the lengths of the pieces and of the
matches gives positions in code points. Running values are taken chunk by chunk, so that a text of very many matches
takes time in proportion to them. Null and empty texts have no spans. Rows with equal ids are verified one by
one, each against the candidates of all; a null id is an id like any other. Columns besides the key and the text are
ignored, or kept by ``redacted``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, free, written


@dataclass(frozen=True)
class Rule:
    """A match of ``regex`` counts if its ``group`` has at least ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.regex}" if self.any_case else self.regex


# The contract's base rules, then further kinds of credentials by their public formats.
BASE = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)

# What is cut out: a private key goes to its footer or, where that is missing, to the end of its lines of base64.
_BREAK = r"(?:\s|\\[nr])*+"
_LINES = rf"(?:\s*+(?:Proc-Type|DEK-Info):[^\n]*+){{0,2}}(?:{_BREAK}[A-Za-z0-9+/=]{{16,}}+){{0,1000}}(?:{_BREAK}[A-Za-z0-9+/]{{2,15}}={{1,2}})?"
_WHOLE = r"(?:(?:[^-]++|-(?!----)){0,64}+-----END [A-Z ]{0,20}PRIVATE KEY-----|" + _LINES + ")"
CUT = tuple(Rule(r.kind, r.regex + _WHOLE) if r.kind == "private_key" else r for r in MORE)


def literal(op, arg) -> set[str] | None:
    """The few strings that one element of a parsed regex stands for, in lower case, or None."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL for o, _ in arg):
        return {chr(c).lower() for _, c in arg}
    if op is sre.SUBPATTERN:
        return sequence_of(arg[-1])
    if op is sre.BRANCH:
        parts = [sequence_of(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 4:
        one = sequence_of(arg[2])
        if one is not None and len(one) ** arg[1] <= 64:
            return {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
    return None


def sequence_of(parts) -> set[str] | None:
    found = {""}
    for op, arg in parts:
        one = literal(op, arg)
        if one is None or len(one) * len(found) > 256:
            return None
        found = {a + b for a in found for b in one}
    return found


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Conjunctions of trigrams, one of which every match contains whole; empty if nothing is mandatory."""
    clauses: list[set[frozenset[str]]] = []
    run = {""}

    def close() -> None:
        if min(map(len, run)) >= 3:
            clauses.append({frozenset(x[k : k + 3] for k in (*range(0, len(x) - 2, 3), len(x) - 3)) for x in run})

    for op, arg in _parser.parse(regex):
        one = literal(op, arg)
        if one is not None and len(one) * len(run) <= 256:
            run = {a + b for a in run for b in one}
        else:
            close()
            run = {""}
    close()
    clauses.sort(key=len)
    whole: set[frozenset[str]] = set()
    for clause in clauses:
        both = {a | b for a in whole or {frozenset()} for b in clause}
        if len(both) <= 64:
            whole = both
    return sorted((a for a in whole if not any(b < a for b in whole)), key=sorted)


def trigram_index(docs: DataFrame, rules: tuple[Rule, ...], key: str, text: str) -> DataFrame:
    """Postings (trigram, id) for the trigrams that the rules' queries ask for."""
    asked = sorted({g for r in rules for c in trigram_query(r.regex) for g in c})
    low = docs.select(F.col(key).alias("id"), F.lower(F.col(text)).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in asked]))
    return low.select("id", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, mask): bit k is set where rule k's query holds."""
    queries = [(k, j, len(c), g) for k, r in enumerate(rules) for j, c in enumerate(trigram_query(r.regex)) for g in sorted(c)]
    asked = index.sparkSession.createDataFrame(queries, "rule int, part int, size int, trigram string")
    hits = index.distinct().join(F.broadcast(asked), "trigram")  # as many rows as the rules have trigrams
    held = hits.groupBy("id", "rule", "part").agg(F.count("*").alias("n"), F.first("size").alias("size")).filter("n = size")
    return held.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("mask"))


#: Elements of an array over which running values are taken at a time.
STRETCH = 256
Join = Callable[[Column, Column], Column]


def paired(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(x.alias("a"), y.alias("b")))


def held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value taken once; what stands in a lambda function is otherwise taken anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, value: Callable[[Column], Column], join: Join) -> Column:
    """For each element, what join makes of 0 and the values of all elements before it. items has to be a name, not an expression."""

    def all_of(some: Column, start: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(some, F.array(start), lambda got, x: F.concat(got, F.array(join(F.element_at(got, -1), of(x)))))

    def over(stretches: Column) -> Column:
        sums = F.transform(stretches, lambda some: F.aggregate(some, F.lit(0), lambda got, x: join(got, value(x))))
        starts = F.slice(all_of(sums, F.lit(0), lambda x: x), F.lit(1), F.size(stretches))
        return F.flatten(F.transform(paired(stretches, starts), lambda z: F.slice(all_of(z["a"], z["b"], value), F.lit(1), F.size(z["a"]))))

    stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / STRETCH).cast("int")), lambda k: F.slice(items, k * STRETCH + 1, STRETCH))
    return F.when(F.size(items) > 0, held(stretches, over)).otherwise(F.expr("cast(array() as array<int>)"))


def spans_of(rule: Rule, text: Column) -> Column:
    """array<struct<start, end>> of a rule's matches that count."""
    java = F.lit(rule.java)
    whole, part = F.regexp_extract_all(text, java, F.lit(0)), F.regexp_extract_all(text, java, F.lit(rule.group))

    def span(x: Column) -> Column:
        start = x["b"] + F.length(x["a"]["0"])
        return F.struct(start.alias("start"), (start + F.length(x["a"]["1"])).alias("end"))

    def spans(pieces: Column) -> Column:
        before = running(pieces, lambda x: F.length(x["0"]) + F.length(x["1"]), lambda a, b: a + b)
        return F.transform(F.filter(paired(pieces, before), lambda x: F.length(x["a"]["2"]) >= rule.least), span)

    # the piece after the last match has no match beside it
    return held(F.filter(F.arrays_zip(F.split(text, rule.java, -1), whole, part), lambda x: x["1"].isNotNull()), spans)


def ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))


def of_rank(spans: Column, rank: int) -> Column:
    return F.filter(spans, lambda x: x["rank"] == rank)


def spanned(docs: DataFrame, rules: tuple[Rule, ...], key: str, text: str, out: str) -> DataFrame:
    """docs with a column out: array<struct<start, rank, end>> by start, then as the rules are listed."""
    index = written(trigram_index(docs, rules, key, text), "trigrams")
    found = written(candidates(index, rules), "candidates")
    dropped(index)
    own_id, mask = free(docs, "__id"), free(docs, "__mask")
    found = found.select(F.col("id").alias(own_id), F.col("mask").alias(mask))
    joined = docs.join(found.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col(own_id)), "left")
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int>>)")
    parts = []
    for k, rule in enumerate(rules):
        maybe = F.col(mask).bitwiseAND(F.lit(1 << k)) != 0 if trigram_query(rule.regex) else body.rlike(rule.java)
        parts.append(F.when(F.coalesce(maybe, F.lit(False)), ranked(spans_of(rule, body), k)).otherwise(none))
    return joined.withColumn(out, F.array_sort(F.concat(*parts))).drop(own_id, mask)


def told(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"], x["end"])), ",")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", more: tuple[Rule, ...] = MORE) -> DataFrame:
    """One row for each row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rules = BASE + more
    found = spanned(docs.select(F.col(key).alias("key"), F.col(text).alias("body")), rules, "key", "body", "found")
    every = F.col("found")
    base = F.filter(every, lambda x: x["rank"] < len(BASE))
    counts = [F.size(of_rank(every, k)).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found.select(F.col("key").alias("doc_id"), *counts, F.sha2(told(base, rules), 256).alias("base_sha256"), told(every, rules).alias("spans"))


def op6_secrets(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return scan(read(spark, sf_dir, "documents"))


#: Characters of a block of text; positions are found within one.
BLOCK = 1024


def stretch(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from start to end, which lie in blocks of BLOCK characters; no others than the blocks they are in are walked."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    tail = F.substr(F.coalesce(F.get(blocks, first), F.lit("")), start % BLOCK + 1, F.lit(BLOCK))
    head = F.substr(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), end % BLOCK)
    one = F.substr(F.get(blocks, first), start % BLOCK + 1, end - start)
    many = F.concat(tail, F.array_join(F.slice(blocks, first + 2, last - first - 1), ""), head)
    return F.when(end <= start, F.lit("")).when(first == last, one).otherwise(many)


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text", more: tuple[Rule, ...] = CUT, mark: str = "[SECRET]") -> DataFrame:
    """docs with each run of characters that spans cover replaced by mark, private keys whole; n_chars follows."""
    out, cut = free(docs, "__spans"), free(docs, "__clean")
    found = spanned(docs, BASE + more, key, text, out)
    spans, body = F.col(out), F.col(text)
    every = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    reached = running(spans, lambda x: x["end"], lambda a, b: F.greatest(a, b))
    # a span that begins before others have ended adds nothing of its own
    fresh = F.filter(paired(spans, reached), lambda x: x["a"]["start"] >= x["b"])
    last = F.array_max(F.transform(spans, lambda x: x["end"]))

    def cut_out(blocks: Column) -> Column:
        parts = F.transform(fresh, lambda x: F.concat(stretch(blocks, x["b"], x["a"]["start"]), F.lit(mark)))
        return F.concat(F.array_join(parts, ""), stretch(blocks, last, F.length(body)))

    clean = held(every, cut_out)
    hit = F.size(spans) > 0
    # the new text has a name of its own: within lambdas, a replaced column's name would mean the replacement
    done = found.withColumn(cut, F.when(hit, clean).otherwise(body))
    new = {text: F.col(cut)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length(cut)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.withColumns(new).select(*docs.columns)


def _sql() -> str:
    """The scan in DuckDB SQL, each rule by its regex over every text."""
    rules = BASE + MORE
    parts = []
    for k, r in enumerate(rules):
        q = r.java.replace("'", "''")
        parts.append(f"""
  select doc_id, {k} as rank, s, s + length(m[i]) as e from (
    select doc_id, m, g, i, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as s
    from (select doc_id, m, g, p, unnest(range(1, len(m) + 1)) as i from (
      select doc_id, regexp_extract_all(t, '{q}', 0) as m, regexp_extract_all(t, '{q}', {r.group}) as g, string_split_regex(t, '{q}') as p from texts where regexp_matches(t, '{q}'))))
  where length(g[i]) >= {r.least}""")
    kinds = ", ".join(f"'{r.kind}'" for r in rules)
    say = f"([{kinds}])[rank + 1] || ':' || s || ':' || e"
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(parts)})
select d.doc_id, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access, count(*) filter (rank = 2) as n_hex,
  sha256(coalesce(string_agg({say}, ',' order by s, rank) filter (rank < {len(BASE)}), '')) as base_sha256,
  coalesce(string_agg({say}, ',' order by s, rank) filter (rank is not null), '') as spans
from documents d left join found f on d.doc_id = f.doc_id group by d.doc_id"""


SQL = _sql()

"""Secret scan with a trigram index, in DataFrame expressions only.

Each rule's regex yields a Boolean query over trigrams of the ASCII-lower-cased text: any match
holds all trigrams of at least one alternative. The index is a table of postings (trigram,
document key) for the trigrams that some rule asks for. Postings are intersected by document, the
queries are evaluated on the result, and a rule's regex runs only on its candidates. Rules
without a mandatory trigram run on every text. Index and queries only ever add candidates, so
the spans are those of a full scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.words import fresh
from tabwright.session import settle

SPAN = "array<struct<start:bigint,place:int,kind:string,end:bigint>>"
REDACTED = "[REDACTED]"


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters or more; a shorter match is dropped without another
    try. Patterns use syntax that Java and RE2 read alike."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Order is the order of kinds at one start. The first three are fixed by contract; a run of 32 or
#: of 16 characters is asked for in the pattern where no shorter match can hide a longer one.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{50,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer) [A-Za-z0-9+/_.=-]{24,}"),
    Rule("url_password", r"""[a-z]{2,16}://[A-Za-z0-9._%-]{1,64}:[A-Za-z0-9._%!$*-]{3,64}@"""),
)

_ALL = [frozenset()]
_MOST = 64


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that a match holds together; None if some
    match may hold no known trigram."""
    exact, needed = _sequence(re._parser.parse(pattern))
    query = _both(needed, _any_of(exact))
    return None if any(not q for q in query) else query


def _any_of(strings: set[str]) -> list[frozenset[str]]:
    return _least([frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in strings])


def _least(query: list[frozenset[str]]) -> list[frozenset[str]]:
    """Without alternatives that another one covers."""
    unique = set(query)
    return sorted((q for q in unique if not any(o < q for o in unique)), key=sorted)


def _both(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    if len(a) * len(b) > _MOST:
        return max(a, b, key=lambda q: min(map(len, q)))
    return _least([x | y for x, y in product(a, b)])


def _sequence(parsed) -> tuple[set[str], list[frozenset[str]]]:
    """The strings that the end of a sequence can be (since the last open part), and the query
    of all before."""
    exact, needed = {""}, _ALL
    for op, value in parsed:
        strings, query = _item(str(op), value)
        if strings is not None and len(exact) * len(strings) <= _MOST:
            exact, needed = {a + b for a, b in product(exact, strings)}, _both(needed, query)
        else:
            needed, exact = _both(_both(needed, _any_of(exact)), _both(query, _any_of(strings or {""}))), {""}
    return exact, needed


def _item(op: str, value) -> tuple[set[str] | None, list[frozenset[str]]]:
    if op == "LITERAL":
        return {chr(value).lower()}, _ALL
    if op == "AT":
        return {""}, _ALL
    if op == "IN":
        if all(str(o) == "LITERAL" for o, _ in value) and len(value) <= 8:
            return {chr(v).lower() for _, v in value}, _ALL
        return None, _ALL
    if op == "SUBPATTERN":
        return _closed(value[3])
    if op == "BRANCH":
        parts = [_closed(p) for p in value[1]]
        if all(s is not None for s, _ in parts) and all(q == _ALL for _, q in parts):
            return set().union(*(s for s, _ in parts)), _ALL
        return None, _least([q for s, n in parts for q in _both(n, _any_of(s or {""}))])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = value
        strings, query = _closed(inner)
        if (low, high) == (0, 1) and strings is not None and query == _ALL:
            return strings | {""}, _ALL
        return None, _both(query, _any_of(strings or {""})) if low else _ALL
    return None, _ALL


def _closed(parsed) -> tuple[set[str] | None, list[frozenset[str]]]:
    """A part as strings if it is nothing else, or as a query."""
    exact, needed = _sequence(parsed)
    if all(str(op) in ("LITERAL", "AT", "IN", "BRANCH", "SUBPATTERN", "MAX_REPEAT") for op, _ in parsed) and needed == _ALL \
            and all(_item(str(op), v)[0] is not None for op, v in parsed):
        return exact, _ALL
    return None, _both(needed, _any_of(exact))


#: Rules that one long tells of.
_RULE_BITS = 62


class TrigramIndex:
    """Postings of the trigrams that the rules ask for, over one table of texts.

    ``postings``: a stored table (trigram int, key long). ``candidates()``: one row per key with
    any candidate rule, and the rules as bits of an array of longs, 62 in each.
    """

    def __init__(self, texts: DataFrame, key: str, text: str, rules: tuple[Rule, ...] = RULES):
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.trigrams = sorted({t for q in self.queries if q for alternative in q for t in alternative})
        low = fresh(texts, "lowered")[0]
        held = F.array_compact(F.array(*(
            F.when(F.col(low).contains(t), F.lit(i)) for i, t in enumerate(self.trigrams))).cast("array<int>"))
        self.postings = settle(
            texts.select(key, F.lower(F.col(text)).alias(low))
            .select(F.explode(held).alias("trigram"), F.col(key).alias("key"))
        )

    def candidates(self) -> DataFrame:
        words = -(-len(self.trigrams) // 64) or 1
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("trigram") % 64)
        sets = self.postings.groupBy("key").agg(*(
            F.coalesce(F.bit_or(F.when(F.floor(F.col("trigram") / 64) == w, bit)), F.lit(0)).alias(f"w{w}")
            for w in range(words)))
        number = {t: i for i, t in enumerate(self.trigrams)}

        def holds(alternative: frozenset[str]) -> Column:
            out = F.lit(True)
            for w in range(words):
                need = sum(1 << (number[t] % 64) for t in alternative if number[t] // 64 == w)
                need -= (need >> 63) << 64
                out = out & (F.col(f"w{w}").bitwiseAND(F.lit(need)) == F.lit(need))
            return out

        rules = [F.lit(0).cast("long") for _ in range(0, len(self.queries), _RULE_BITS)] or [F.lit(0).cast("long")]
        for i, query in enumerate(self.queries):
            if query:
                one = F.lit(False)
                for alternative in query:
                    one = one | holds(alternative)
                at, bit = divmod(i, _RULE_BITS)
                rules[at] = rules[at].bitwiseOR(F.when(one, F.lit(1 << bit)).otherwise(0).cast("long"))
        return sets.select("key", F.array(*rules).alias("rules")).where(F.exists("rules", lambda r: r != 0))


def _before(values: Column) -> Column:
    """For each number of an array the sum of those before it. In two levels, as adding to an
    array copies it."""
    piece, zero = 256, F.array(F.lit(0).cast("long"))
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(piece))
    pieces = F.transform(F.arrays_zip(starts.alias("at"), F.array_repeat(values, F.size(starts)).alias("all")),
                         lambda z: F.aggregate(F.slice(z["all"], z["at"] + 1, F.lit(piece)), zero, add))
    sums = F.aggregate(pieces, zero, lambda s, p: add(s, F.element_at(p, -1)))
    return F.flatten(F.zip_with(pieces, sums, lambda p, s: F.transform(
        F.slice(F.coalesce(p, F.array().cast("array<bigint>")), F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda x: x + s)))


def _spans(part: Column) -> Column:
    """Spans of one rule's matches, from the matches, the gaps around them and the sized group."""
    sized = F.zip_with(part["gaps"], part["found"], lambda g, m: F.struct(
        F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("size")))
    steps = F.filter(F.zip_with(sized, part["inner"], lambda s, v: F.struct(
        s["gap"].alias("gap"), s["size"].alias("size"), F.length(v).alias("value"))), lambda s: s["size"].isNotNull())
    ends = _before(F.transform(steps, lambda s: s["gap"] + s["size"]))
    spans = F.zip_with(steps, ends, lambda s, b: F.struct(
        (b + s["gap"]).alias("start"), part["place"].alias("place"), part["kind"].alias("kind"),
        (b + s["gap"] + s["size"]).alias("end"), s["value"].alias("value")))
    kept = F.filter(spans, lambda s: s["start"].isNotNull() & (s["value"] >= part["least"]))
    return F.transform(kept, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "place", "kind", "end"))))


def find_secrets(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id",
                 rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """The documents with their spans (start, place of the kind, kind, past-the-end; code points,
    in order of start and kind) in an array column whose name is returned.

    Null and empty texts have no spans. Rows are never lost or joined to each other: a document is
    looked up among the candidates by a hash of id and text, and a clash of hashes only costs a
    needless scan. Columns of any other name are kept.
    """
    key, bits, out = fresh(docs, "scan_key", "scan_rules", "secrets")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_column).cast("string"), F.col(text)))
    index = TrigramIndex(keyed.select(key, text), key, text, rules)
    chosen = index.candidates().select(F.col("key").alias("__key"), F.col("rules").alias(bits))
    joined = keyed.join(chosen.hint("shuffle_hash"), F.col(key) == F.col("__key"), "left").drop("__key")
    found_names = fresh(joined, *(f"found_{r.kind}" for r in rules))
    body, none = F.col(text), F.array().cast("array<string>")

    def found(i: int, rule: Rule) -> Column:
        matches = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(0))
        if index.queries[i]:
            at, bit = divmod(i, _RULE_BITS)
            return F.when(F.get(bits, F.lit(at)).bitwiseAND(F.lit(1 << bit)) != 0, matches).otherwise(none)
        return F.coalesce(matches, none)

    scanned = joined.withColumns({n: found(i, r) for i, (n, r) in enumerate(zip(found_names, rules))})

    def part(i: int, rule: Rule, n: str) -> Column:
        inner = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else F.col(n)
        return F.when(F.size(n) > 0, F.struct(
            F.lit(i).alias("place"), F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"),
            F.split(body, rule.pattern, -1).alias("gaps"), F.col(n).alias("found"), inner.alias("inner")))

    parts = F.array_compact(F.array(*(part(i, r, n) for i, (n, r) in enumerate(zip(found_names, rules)))))
    spans = F.array_sort(F.flatten(F.transform(parts, _spans))).cast(SPAN)
    return scanned.select(*docs.columns, spans.alias(out)), out


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (see the contract)."""
    found, name = find_secrets(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter(name, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(name, lambda s: s["place"] < 3)
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
                        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col(name)).alias("spans"))


def redact(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id", length: str | None = None,
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every secret, overlapping ones as one, replaced by ``[REDACTED]``.
    Columns as they came; ``length``, if given, is a column that gets the new length."""
    found, name = find_secrets(docs, text=text, id_column=id_column, rules=rules)
    body = F.col(text)
    start = F.struct(F.lit(0).cast("long").alias("past"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["past"]
        gap = F.substring(body, (acc["past"] + 1).cast("int"), (s["start"] - acc["past"]).cast("int"))
        return F.struct(F.greatest(acc["past"], s["end"]).alias("past"),
                        F.when(new, F.concat(acc["out"], gap, F.lit(REDACTED))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(name, start, step, lambda acc: F.concat(
        acc["out"], F.substring(body, (acc["past"] + 1).cast("int"), F.length(body))))
    out = found.withColumn(text, F.when(F.size(name) > 0, clean).otherwise(body))
    if length:
        out = out.withColumn(length, F.when(F.size(name) > 0, F.length(text)).otherwise(F.col(length)).cast(docs.schema[length].dataType))
    return out.select(*docs.columns)

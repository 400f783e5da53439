"""Personal data: generators propose spans, boosted trees judge them, calibrated thresholds select.

Base spans are fixed by contract. The generators are wider: obfuscated addresses, numbers with
any separators, account numbers, phone numbers without a plus; their spans overlap. Each
candidate has features of its format and of its surroundings. No span labels exist, so
the trees learn from the candidates themselves. Examples are those that a base rule accepts or that
pass an account number's check digits, and base spans rewritten in place into the wider forms:
obfuscated addresses, phone numbers without their plus, other separators. Counter-examples are
those that fail every rule and have no such form; found candidates that have one are neither.
In half of the examples the features that a rule decides by are hidden, so format and surroundings
are learnt too. Probabilities are calibrated on candidates not fitted on, and each generator
gets the lowest threshold that reaches the wanted precision there, or none at all; base spans do
not count for that, as they are never scored. Made-up texts of every form are learned from besides, so that a small table,
or one with few examples of a form, does not leave that form out.

Fitting runs the generators over all documents once and fits on every example: equal ones are one row with their
number, and the trees need sums over these rows only. So that no generator or class outweighs the others, each has a
bounded weight in the fit; thresholds go by plain numbers of examples. Scanning is one narrow pass over whole texts.
"""

from __future__ import annotations

import hashlib
import pickle
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.boost import Boosted, binned, calibrate_by_sums, fit_binned, total_of
from tabwright.llm.words import fresh
from tabwright.operators.cumulate import bucket_edges, running_totals

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts within a run of digits: where its start fails, so does the rest of the run
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

#: Generators of the method, in the order of kinds after the base ones.
GENERATORS = {
    "address_like": re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:@|\x20?[(\[]\x20?(?:at|AT)\x20?[)\]]\x20?)[A-Za-z0-9-]{1,63}"
                               r"(?:(?:\.|\x20?[(\[]\x20?(?:dot|DOT)\x20?[)\]]\x20?)[A-Za-z0-9-]{1,63})+"),
    "dotted": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.:][0-9]{1,3}){3}(?![0-9])"),
    "number": re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){8,21}(?![0-9])"),
    "dialled": re.compile(r"(?<![0-9])(?:\+|00|\()?[0-9][\x20()./0-9-]{6,20}[0-9](?![0-9])"),
    "account": re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
}
_CUES = ("mail", "phone", "tel", "call", "fax", "mobil", "card", "visa", "iban", "account", "konto", "ip", "host", "server", "ssn", "contact")


@dataclass(frozen=True)
class Pii:
    """``most_rows``: the examples of all documents weigh at most as much as so many rows in the fit, in equal parts for each
    generator and class of examples; all are fitted on or held out. ``generated``: texts of each sort that are made up and learned from besides, so that few found ones
    do not leave a form unlearned. ``precision``: wanted of each generator on held-out candidates."""

    most_rows: int = 40_000
    generated: int = 200
    precision: float = 0.98
    least_examples: int = 20
    seed: int = 42


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def account_check(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their @: the part before it is the run that ends there."""
    out, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            out.append((start, past))
        at = text.find("@", max(at + 1, past))
    return out


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, past-the-end), by start and kind."""
    out = [(a, 0, "email", b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, "ip", m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, "card", m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, past-the-end, generator) of all generators; they overlap."""
    out = []
    address = "@" in text or "(at" in text.lower() or "[at" in text.lower()
    numbers = _DIGIT.search(text) is not None
    for g, (name, pattern) in enumerate(GENERATORS.items()):
        if (address if name == "address_like" else numbers):
            out += [(m.start(), m.end(), g) for m in pattern.finditer(text)]
    return out


_DATE = re.compile(r"(?:19|20)[0-9]{2}[./ -][0-9]{1,2}[./ -][0-9]{1,2}(?![0-9])|[0-9]{1,2}[./ -][0-9]{1,2}[./ -](?:19|20)[0-9]{2}(?![0-9])"
                   r"|(?:19|20)[0-9]{2}\x20?[/-]\x20?(?:19|20)[0-9]{2}(?![0-9])")


def wider_form(text: str, span: tuple[int, int, int]) -> bool:
    """Whether a candidate is written as wider_spans writes, so that failing the base rules says nothing of it.
    Runs of digits, dates and four dotted groups are not."""
    a, b, g = span
    body = text[a:b]
    if g == 0:
        return "(" in body or "[" in body
    if g not in (2, 3) or body.isdigit() or _DATE.match(body) or GENERATORS["dotted"].fullmatch(body):
        return False
    digits = "".join(c for c in body if c.isdigit())
    return 7 <= len(digits) <= 15 or len(digits) <= 19 and luhn(digits)


def wider_spans(kind: str, body: str) -> list[str]:
    """A base span in the forms that the base rules leave out."""
    if kind == "email":
        local, domain = body.rsplit("@", 1)
        labels = domain.split(".")
        return [f"{local} (at) {' (dot) '.join(labels)}", f"{local}[at]{'[dot]'.join(labels)}", f"{local} (at) {domain}",
                f"{local} [AT] {' [DOT] '.join(labels)}", f"{local}(at){'(dot)'.join(labels)}", f"{local}@{' (dot) '.join(labels)}"]
    groups = re.findall("[0-9]+", body)
    digits = "".join(groups)
    if kind == "card":
        return [".".join(digits[i: i + 4] for i in range(0, len(digits), 4))]
    if kind != "phone":
        return []
    code = groups[0] if len(groups) > 1 and len(groups[0]) <= 3 else digits[: 1 if digits[0] in "17" else 2]
    rest = groups[1:] if len(groups) > 1 and len(groups[0]) <= 3 else [digits[len(code):]]
    if len(rest) == 1:
        rest = [rest[0][:3], rest[0][3:6], rest[0][6:]]
    first, last = rest[0], rest[1:]
    return [body[1:], f"({first}) {'-'.join(last)}", "-".join(rest), ".".join(rest), " ".join(rest), f"0{' '.join(rest)}", f"0{first}/{'-'.join(last)}",
            f"(0{first}) {' '.join(last)}", f"0{'-'.join(rest)}", f"00{code} {' '.join(rest)}", f"0{''.join(rest)}"]


#: Features that a base rule decides by; they come last.
RULED = ("luhn", "octets", "account_digits", "plus", "at")


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and surroundings of a candidate, then what the rules decide by."""
    a, b, g = span
    body = text[a:b]
    digits = "".join(c for c in body if c.isdigit())
    before, after = text[max(0, a - 40): a].lower(), text[b: b + 12]
    edge = lambda c: [float(c.isalpha()), float(c.isspace()), float(not c or not (c.isalnum() or c.isspace()))]
    groups = re.split(r"[^0-9]+", body.strip("()+ "))
    return [
        *(float(g == i) for i in range(len(GENERATORS))), float(b - a), float(len(digits)), float(sum(c.isalpha() for c in body)),
        float(body.count(" ")), float(body.count("-")), float(body.count(".")), float(body.count("(")), float(len(groups)),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)), float(len(set(digits))),
        *edge(text[a - 1: a]), *edge(text[b: b + 1]), *(float(c in before) for c in _CUES),
        float(before.rstrip().endswith((":", "=", "#"))), float(bool(after[:1] == "%" or after.lstrip()[:2] in ("eu", "us"))),
        float(body.count("/")), float(body.count("[")), float(body.startswith(("0", "(0"))), float(body.startswith("00")), float(bool(_DATE.match(body))),
        float(luhn(digits) if digits.isascii() and digits else 0),
        float(len(groups) == 4 and all(x and len(x) <= 3 and int(x) <= 255 for x in groups)) if digits.isascii() else 0.0,
        float(g == 4 and account_check(body)), float(body.startswith("+")), float("@" in body),
    ]


#: Classes of examples.
FAILED, BASE, WIDER = range(3)
#: Characters around a rewritten span that are looked at, and the forms that a base span is rewritten into.
_AROUND, _FORMS = 64, 3
#: Distinct examples that a task sums at least.
_PART_ROWS = 50_000


def _examples(text: str) -> list[tuple[str, tuple[int, int, int], int, int]]:
    """(text around, candidate, class, generator) of the candidates of a text and of its base spans in wider forms."""
    found, spans = candidates(text), base_spans(text)
    base = {(a, b) for a, _, _, b in spans}
    out = []
    for c in found:
        sure = c[2] == 4 and account_check(text[c[0]: c[1]])
        if sure or (c[0], c[1]) in base or not wider_form(text, c):
            out.append((text, c, WIDER if sure else BASE if (c[0], c[1]) in base else FAILED, c[2]))
    for a, _, kind, b in spans:
        forms = wider_spans(kind, text[a:b])
        turn = zlib.crc32(text[a:b].encode("utf-8", "replace"))
        left = text[max(0, a - _AROUND): a]
        for form in [forms[(turn + i) % len(forms)] for i in range(min(_FORMS, len(forms)))]:
            around = left + form + text[b: b + _AROUND]
            out += [(around, c, WIDER, c[2]) for c in candidates(around) if c[:2] == (len(left), len(left) + len(form))]
    return out


def made_up(n: int, seed: int) -> list[str]:
    """Texts with invented data of every base kind and account numbers, and as many with numbers that are none: dates, orders,
    versions, amounts, account numbers whose check fails."""
    draw = random.Random(seed)

    def digits(k: int) -> str:
        return "".join(draw.choice("0123456789") for _ in range(k))

    def word(least: int = 2) -> str:
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(least, 9)))

    def checked_card() -> str:
        head = digits(15)
        last = next(d for d in "0123456789" if luhn(head + d))
        sep = draw.choice(["", " ", "-"])
        return sep.join((head + last)[i: i + 4] for i in range(0, 16, 4))

    def account(right: bool) -> str:
        country, body = draw.choice(["DE", "FR", "ES", "IT", "NL", "GB"]), digits(draw.choice([14, 18, 20]))
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        text = f"{country}{(check if right else (check + draw.randint(1, 95)) % 97):02d}{body}"
        return " ".join(text[i: i + 4] for i in range(0, len(text), 4)) if draw.random() < 0.5 else text

    def phone() -> str:
        groups = [digits(draw.randint(2, 4)) for _ in range(3)]
        return f"+{draw.randint(1, 99)} " + draw.choice(["{} {} {}", "({}) {} {}", "{}-{}-{}", "({}) {}-{}"]).format(*groups)

    sorts = [
        (("mail", "contact", ""), lambda: f"{word()}{draw.choice(['', '.', '_'])}{word()}@{word()}.{draw.choice(['com', 'org', 'net', 'de'])}"),
        (("phone", "call", "tel", "fax", ""), phone), (("card", "visa", ""), checked_card),
        (("host", "server", "ip", ""), lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4))),
        (("iban", "account", "konto", ""), lambda: account(True)), (("iban", "ref", "code", ""), lambda: account(False)),
        (("on", "since", ""), lambda: draw.choice(["{y}-{m:02d}-{d:02d}", "{d:02d}.{m:02d}.{y}", "{m}/{d}/{y}", "{y} - {z}"]).format(
            y=draw.randint(1950, 2040), z=draw.randint(1950, 2040), m=draw.randint(1, 12), d=draw.randint(1, 28))),
        (("order", "id", "ticket", "number", ""), lambda: digits(draw.randint(9, 19))),
        (("version", "build", ""), lambda: f"{draw.randint(0, 20)}.{draw.randint(0, 999)}.{draw.randint(256, 999)}.{draw.randint(0, 99)}"),
        (("total", "from", "sum", ""), lambda: f"{digits(3)}.{digits(3)}.{digits(3)}" if draw.random() < 0.5 else f"{digits(2)} {digits(3)} {digits(3)} {digits(2)} eur"),
    ]
    out = []
    for cues, make in sorts:
        for _ in range(n):
            before, after = (" ".join(word() for _ in range(draw.randint(0, 6))) for _ in "ab")
            out.append(f"{before} {draw.choice(cues)}{draw.choice([' ', ': ', ' is '])}{make()}{draw.choice(['', '.', ','])} {after}")
    return out


@dataclass
class Judge:
    model: Boosted
    thresholds: np.ndarray

    def chosen(self, spans: list[tuple[int, int, int]], x: np.ndarray) -> list[tuple[float, int, int, int]]:
        p = self.model.probability(x)
        return [(float(q), *s) for q, s in zip(p, spans) if q >= self.thresholds[s[2]]]


def _dealt(data: bytes) -> float:
    """A number in [0, 1) for each value."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big") / 2 ** 64


def _described(text: str, fit: bool, seed: bytes) -> Iterator[tuple[bytes, int, int, bool]]:
    """Features, class, generator and side of the examples of a text. In half of those fitted on, what the rules decide by is hidden."""
    for i, (around, c, k, g) in enumerate(_examples(text)):
        x = np.array(features(around, c), np.float32)
        if fit and _dealt(seed + i.to_bytes(8, "big")) < 0.5:
            x[-len(RULED):] = -1.0
        yield x.tobytes(), k, g, fit


def _rows_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(batch.num_rows, -1)


def _edges(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Values of each feature to cut at: all but the last where there are at most ``bins``, else quantiles by weight."""
    def values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, w = _rows_of(batch), np.rint(batch.column("w").to_numpy() * 2 ** 20)
            found = [np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(found)), [len(v) for v, _ in found]), pa.int32()), pa.array(np.concatenate([v for v, _ in found]), pa.float64()),
                 pa.array(np.concatenate([np.bincount(at, w, len(v)) for v, at in found]).astype(np.int64))], names=["f", "v", "w"])

    by = Window.partitionBy("f")
    so_far, everything = F.sum("w").over(by.orderBy("v")), F.sum("w").over(by)
    found = rows.mapInArrow(values, "f int, v double, w long").groupBy("f", "v").agg(F.sum("w").alias("w")).select(
        "f", "v", F.count("v").over(by).alias("n"), F.max("v").over(by).alias("last"),
        F.floor(bins * so_far / everything).alias("after"), F.floor(bins * (so_far - F.col("w")) / everything).alias("before"))
    kept = found.where((F.col("v") < F.col("last")) & ((F.col("n") <= bins) | (F.col("after") > F.col("before")))).collect()
    return [np.sort(np.array([r["v"] for r in kept if r["f"] == f], float)) for f in range(width)]


def _thresholds(scored: DataFrame, model: Boosted, settings: Pii) -> np.ndarray:
    """The lowest of each generator that reaches the precision, by the counts of all held-out examples at and above each margin."""
    held = scored.where(F.col("k") != BASE).groupBy("g", "m").agg(
        F.sum("n").cast("double").alias("n"), F.sum(F.when(F.col("k") == FAILED, 0).otherwise(F.col("n"))).cast("double").alias("hits")).withColumn("at", F.col("m"))
    summed = running_totals(held, "m", ["n", "hits", "at"], bucket_edges(held, "m"), ["g"])
    good = summed.where((F.col("cum_hits") >= settings.precision * F.col("cum_n")) & (F.col("cum_hits") >= settings.least_examples))
    thresholds = np.full(len(GENERATORS), np.inf)
    for r in good.groupBy("g").agg(F.min("m").alias("m"), F.min_by("next_at", "m").alias("below")).collect():
        at = model.calibrated(np.array([r["m"], -np.inf if r["below"] is None else r["below"]]))
        below = 0.0 if r["below"] is None else at[1]
        thresholds[r["g"]] = max(0.5, float(at[0] + below) / 2)  # between the last margin taken and the next one
    return thresholds


def fit_judge(docs: DataFrame, settings: Pii = Pii(), *, text: str = "text") -> Judge:
    """Trees and thresholds from the examples of all documents and from made-up ones. Equal texts are on one side of the split."""
    seed, width, bins = settings.seed, len(features(" ", (0, 1, 0))), 32

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter[tuple[bytes, int, int, bool]] = Counter()
            for t in batch.column(0).to_pylist():
                own = hashlib.blake2b(f"{seed}:{t}".encode("utf-8", "replace"), digest_size=16).digest()
                n.update(_described(t or "", _dealt(own) < 0.5, own))
            yield pa.RecordBatch.from_arrays([*(pa.array([x[i] for x in n], k) for i, k in enumerate((pa.binary(), pa.int32(), pa.int32(), pa.bool_()))),
                                              pa.array(list(n.values()), pa.int64())], names=["x", "k", "g", "fit", "n"])

    made = Counter(d for i, t in enumerate(made_up(settings.generated, seed)) for d in _described(t, i % 2 == 0, f"{seed}:{i}".encode()))
    found = docs.select(text).mapInArrow(gather, "x binary, k int, g int, fit boolean, n long").withColumn("made", F.lit(False))
    invented = docs.sparkSession.createDataFrame([(*d, n, True) for d, n in made.items()], found.schema)
    # equal examples are one row with their number
    examples = found.unionByName(invented).groupBy("x", "k", "g", "fit", "made").agg(F.sum("n").alias("n")).persist()
    facts = examples.groupBy("k", "g", "made").agg(F.sum("n").alias("n"), F.count_if("fit").alias("fit"), F.count_if(~F.col("fit")).alias("held")).collect()
    each = settings.most_rows / (len((FAILED, BASE, WIDER)) * len(GENERATORS))
    rates = {(r["k"], r["g"]): min(1.0, each / r["n"]) for r in facts if not r["made"]}
    share = F.lit(1.0)
    for (k, g), rate in rates.items():
        share = F.when(~F.col("made") & (F.col("k") == k) & (F.col("g") == g), rate).otherwise(share)
    examples_weighed = examples.withColumn("w", F.col("n") * share)

    def blocks(rows: DataFrame, n: int, row: Callable[[pa.RecordBatch], np.ndarray]) -> RDD:
        """Blocks of what a function gives for rows, with classes and weights, held for many passes."""
        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                y, x = (batch.column("k").to_numpy() != FAILED).astype(np.uint8), pickle.dumps(row(batch))
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in (x, y.tobytes(), batch.column("w").to_numpy().tobytes())], names=["x", "y", "w"])

        packed = rows.coalesce(max(1, -(-n // _PART_ROWS))).mapInArrow(pack, "x binary, y binary, w binary")
        return packed.rdd.map(lambda r: (pickle.loads(r.x), np.frombuffer(r.y, np.uint8).astype(float), np.frombuffer(r.w, float))).persist(StorageLevel.MEMORY_AND_DISK)

    fitted = examples_weighed.where("fit")
    edges = _edges(fitted, width, bins)
    shown = blocks(fitted, sum(r["fit"] for r in facts), lambda batch: binned(_rows_of(batch), edges))
    model = fit_binned(total_of(shown), edges, bins=bins)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("g", "k", "n", "w")), pa.array(model.margin(_rows_of(batch)))], names=["g", "k", "n", "w", "m"])

    scored = examples_weighed.where("NOT fit").mapInArrow(score, "g int, k int, n long, w double, m double").persist()
    margins = blocks(scored, sum(r["held"] for r in facts), lambda batch: batch.column("m").to_numpy())
    calibrate_by_sums(model, total_of(margins))
    thresholds = _thresholds(scored, model, settings)
    for held in (examples, scored, shown, margins):
        held.unpersist()
    return Judge(model, thresholds)


def added(chosen: list[tuple[float, int, int, int]], base: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Of the chosen candidates those that overlap no base span and no likelier candidate."""
    covered: list[tuple[int, int]] = []  # without overlaps, in order
    for a, _, _, b in sorted(base):
        if covered and a < covered[-1][1]:
            covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
        else:
            covered.append((a, b))
    out = []
    names = list(GENERATORS)
    for _, a, b, g in sorted(chosen, key=lambda c: (-c[0], c[1], c[2], c[3])):
        at = bisect_left(covered, (b,))  # the first one that starts at the end or later
        if not at or covered[at - 1][1] <= a:
            covered.insert(at, (a, b))
            out.append((a, len(KINDS) + g, names[g], b))
    return out


def find_pii(docs: DataFrame, judge: Judge, *, text: str = "text") -> tuple[DataFrame, str]:
    """The documents without their text, with all spans (start, place, kind, end; code points, by start
    and kind) in a column whose name is returned. Null and empty texts have none; every row
    is scanned on its own and whole."""
    rest = [c for c in docs.columns if c != text]
    (name,) = fresh(docs, "pii")
    span = pa.struct([("start", pa.int64()), ("place", pa.int32()), ("kind", pa.string()), ("end", pa.int64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(text).to_pylist():
                t = t or ""
                spans = base_spans(t)
                base = {(a, b) for a, _, _, b in spans}
                proposed = [c for c in candidates(t) if (c[0], c[1]) not in base]
                if proposed:
                    x = np.array([features(t, c) for c in proposed], float)
                    spans = sorted(spans + added(judge.chosen(proposed, x), spans))
                out.append([dict(zip(("start", "place", "kind", "end"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out, pa.list_(span))], names=[*rest, name])

    schema = docs.select(*rest).selectExpr("*", f"CAST(NULL AS array<struct<start:bigint,place:int,kind:string,end:bigint>>) AS {name}").schema
    return docs.select(*rest, text).mapInArrow(work, schema), name


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, settings: Pii = Pii()) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (see the contract)."""
    found, name = find_pii(docs.select("doc_id", "text"), fit_judge(docs, settings))
    count = lambda place: F.size(F.filter(name, lambda s: s["place"] == place)).cast("long")
    base = F.filter(name, lambda s: s["place"] < len(KINDS))
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col(name)).alias("spans"))

"""Operator 4: personal data by candidate generation and gradient boosting.

Strict patterns with their checks give the base spans, which are always kept. Loose generators propose more,
overlapping spans: spelled-out addresses, numbers with other separators or without a country code, and so
on. Boosted trees judge a proposal by its format (digits, groups, separators, checksums) and context (the
characters and words around it). A proposal is taken if its probability reaches the threshold of its kind,
which is calibrated on rows the trees were not fitted to; of overlapping ones the most probable.

The trees learn from all rows: base spans, and the same spans rewritten the way people write
them differently, are right; spans that fail the checks, and rewritten ones with broken numbers, are wrong. Other loose
proposals are not known: they count as right by their chance of being personal data that the checks do not
see (:func:`boosting.chances`), and as wrong for the rest. Kinds count alike, however rare one of them is.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from voltlake.llm import boosting
from voltlake.llm.common import hash_sample, id_and_text, steps
from voltlake.sources.staging import staged

KINDS = ("email", "ip", "card", "phone")
#: Different examples in a block that tasks make sums of, at most.
BLOCK_ROWS = 1 << 16
#: Different examples that the driver sums itself, at most.
DRIVER_ROWS = 1 << 16
PRECISION = 0.98
CALIBRATION_SHARE = 3
CONTEXT = 32

# The strict patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

AT = r"(?:\s?@\s?|\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)"
DOT = r"(?:\s?\.\s?|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
WORDED_AT = re.compile(r"[\[({]\s?at\s?[\])}]|\sat\s|\s@\s", re.I)
WORDED_DOMAIN = re.compile(rf"{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I)
WORDED_LOCAL = re.compile(rf"[A-Za-z0-9_%+-]{{1,64}}(?:{DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,2}}$", re.I)
LOOSE = {
    "ip": re.compile(
        r"(?<![0-9])[0-9]{1,3}(?:\s?(?:\.|[\[({](?:\.|\s?dot\s?)[\])}])\s?[0-9]{1,3}){3}(?![0-9])"
        r"|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
    ),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{3,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,5}(?![0-9])"),
}

#: What rows with each kind have at least, for the sample.
LIKE = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": "[0-9]([ -]?[0-9]){12}",
    "phone": r"\+[0-9]",
}

CUES = {
    "email": re.compile(r"mail|contact|write|@|reach", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr|login|client", re.I),
    "card": re.compile(r"card|visa|master|credit|debit|pay|account", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|cell|dial|contact", re.I),
}
AGAINST = re.compile(r"token|passw|secret|key|hash|order|invoice|\bid\b|\bref|\bno\b|version|isbn|date|year|page", re.I)
WORTH_A_LOOK = re.compile(r"[0-9@]|[\[({]\s?at\s?[\])}]", re.I)
#: The same for Spark, with spelled-out addresses.
LEARNED_FROM = r"(?i)[0-9@]|[\[({]\s?at\s?[\])}]| dot "

Span = tuple[int, int, int]


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: the run before each ``@`` with the domain after it, in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", at + 1)


def strict(text: str) -> Iterator[tuple[Span, bool]]:
    """Every match of the strict patterns, and whether it passes the checks; by kind, then start."""
    if "@" in text:
        for start, end in emails(text):
            yield (0, start, end), True
    for m in IP.finditer(text):
        yield (1, *m.span()), small_parts(m[0])
    for m in CARD.finditer(text):
        number = digits(m[0])
        yield (2, *m.span()), 13 <= len(number) <= 19 and luhn(number)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield (3, *m.span()), 9 <= len(digits(m[0])) <= 15


def proposals(text: str) -> set[Span]:
    """Spans of the loose generators; they overlap each other and the strict ones."""
    out: set[Span] = set()
    for m in WORDED_AT.finditer(text):
        domain = WORDED_DOMAIN.match(text, max(0, m.start() - 1)) or WORDED_DOMAIN.match(text, m.start())
        if domain and (" dot " in domain[0].lower() or m[0].strip() != "at"):
            local = WORDED_LOCAL.search(text[max(0, domain.start() - 200) : domain.start()])
            if local:
                out.add((0, domain.start() - len(local[0]), domain.end()))
    for kind, pattern in LOOSE.items():
        out.update((KINDS.index(kind), *m.span()) for m in pattern.finditer(text))
    return out


def features(text: str, span: Span) -> list[float]:
    """Format of a span and its context."""
    kind, start, end = span
    own = text[start:end]
    number = digits(own)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = [len(g) for g in re.findall(r"[0-9]+", own)]
    separators = [c for c in own if not c.isalnum()]
    left, right = text[start - 1 : start], text[end : end + 1]
    octets = re.findall(r"[0-9]+", own)
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(own), len(number), len(number) / max(1, len(own)), sum(c.isalpha() for c in own),
        len(groups), max(groups, default=0), min(groups, default=0), len(separators), len(set(separators)),
        float(13 <= len(number) <= 19 and luhn(number)),
        float(len(octets) == 4 and all(len(o) <= 3 and int(o) <= 255 for o in octets)),
        float("@" in own), float(own[:1] == "+" or own[:2] == "00"), float("(" in own),
        float("at" in own.lower()), float("dot" in own.lower()), float(":" in own),
        float(left.isalnum()), float(right.isalnum()), float(left in ('"', "=", "_", "/")), float(right in ('"', "=", "_", "/")),
        float(bool(CUES[KINDS[kind]].search(before))), float(bool(CUES[KINDS[kind]].search(after))),
        float(bool(AGAINST.search(before))),
    ]


def rewritten(text: str, span: Span, rng: np.random.Generator) -> Iterator[tuple[str, Span, bool]]:
    """A base span as people also write it, and broken so that it is none any more; in its context."""
    kind, start, end = span
    own = text[start:end]
    before, after = text[max(0, start - 2 * CONTEXT) : start], text[end : end + 2 * CONTEXT]

    def put(new: str, good: bool) -> tuple[str, Span, bool]:
        return before + new + after, (kind, len(before), len(before) + len(new)), good

    if kind == 0:
        at, dot = ((" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."))[rng.integers(3)]
        yield put(own.replace("@", at).replace(".", dot), True)
    elif kind == 1:
        yield put(own.replace(".", ("[.]", " . ", "(.)")[rng.integers(3)]), True)
        parts = own.split(".")
        parts[rng.integers(4)] = str(rng.integers(256, 999))
        yield put(".".join(parts), False)
    elif kind == 2:
        number = digits(own)
        mark = ".-/ "[rng.integers(4)]
        grouped = mark.join(number[k : k + 4] for k in range(0, len(number), 4))
        yield put(grouped, True)
        yield put(grouped[:-1] + str((int(grouped[-1]) + 1 + rng.integers(8)) % 10), False)
    else:
        number = re.sub(r"^\+[0-9]{1,2}\s?", "", own)
        yield put(number.replace(" ", (" ", ".", "-")[rng.integers(3)]), True)
        yield put(re.sub("[^0-9]+", (" ", ".", "-")[rng.integers(3)], number).strip(" .-"), True)
        yield put(re.sub(r"^\(?([0-9]+)\)?", r"(\1)", number), True)
        long = number + "".join(str(d) for d in rng.integers(10, size=16))
        yield put(" ".join(digits(long)[k : k + 4] for k in range(0, 16 + 4 * rng.integers(2), 4)), False)
        yield put("-".join((str(rng.integers(1900, 2100)), f"{rng.integers(1, 13):02}", f"{rng.integers(1, 29):02}")), False)


def overlaps(a: Span, b: Span) -> bool:
    return a[1] < b[2] and b[1] < a[2]


class Model:
    """Boosted trees and the threshold of each kind."""

    def __init__(self, trees: boosting.Boosted, thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans: both by kind, then start."""
        if not WORTH_A_LOOK.search(text) and " dot " not in text.lower():
            return [], []
        base = [s for s, good in strict(text) if good]
        taken = sorted(base, key=lambda s: s[1])
        more = sorted(s for s in proposals(text) if not _touches(s, taken))
        if more:
            p = self.trees.probability(np.array([features(text, s) for s in more]))
            chosen: list[Span] = []
            for k in sorted(range(len(more)), key=lambda k: (-p[k], more[k][1] - more[k][2], more[k])):
                if p[k] >= self.thresholds[more[k][0]] and not any(overlaps(more[k], c) for c in chosen):
                    chosen.append(more[k])
            return base, sorted(base + chosen)
        return base, base


def _touches(span: Span, taken: list[Span]) -> bool:
    return any(overlaps(span, t) for t in taken)


def learn(docs: DataFrame, sample_rows: int | None = None, sample_proposals: int | None = None) -> Model:
    """A model from all rows; a third of them, by doc_id, calibrates.

    Examples are written once. Trees see them by bins of their features, so equal ones are counted, and tasks make
    histograms of the different ones: only those, value counts of the cuts and levels of the thresholds come to the
    driver, in an amount that does not depend on the rows.

    A caller may ask for a sample: at most ``sample_rows`` rows with a doc_id, equal parts that look like each kind and
    like none but with digits, of each the rows of the smallest hashes; and at most ``sample_proposals`` examples.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs).where(F.col("text").rlike(LEARNED_FROM))
    if sample_rows is not None:
        rows = rows.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
        like = [F.when(F.col("text").rlike(LIKE[k]), F.lit(k)) for k in KINDS]
        kinds = F.array_compact(F.array(*like, F.when(F.coalesce(*like).isNull(), F.lit("none"))))
        rows = rows.select("doc_id", "text", F.explode(kinds).alias("kind"))
        rows = hash_sample(rows, "kind", sample_rows // (len(KINDS) + 1), "doc_id").select("doc_id", "text").distinct()
    found = rows.mapInArrow(examples, "held boolean, x array<double>, y boolean, made boolean")
    if sample_proposals is not None:
        mixed = F.xxhash64("held", "x", "y", "made")
        found = found.orderBy(mixed, "x", "y", "made").limit(sample_proposals)
    with staged(found) as found:
        cuts = cuts_of(found)
        with staged(blocks_of(found, cuts)) as packed:
            with summing(packed, len(cuts)) as total:
                return fitted(total, cuts)


@contextmanager
def summing(packed: DataFrame, width: int) -> Iterator[boosting.Total]:
    """Sums over blocks: by tasks, or here if there are few different examples. They are exact, so equal in either case."""
    none = np.zeros(0, dtype=bool)
    empty = boosting.Rows(np.zeros((0, width), np.uint8), np.zeros(0), none, none, none, none.astype(int), none)
    if (packed.agg(F.sum(F.octet_length("n") / 8)).first()[0] or 0) <= DRIVER_ROWS:
        here = [empty, *map(block, packed.collect())]
        yield lambda part: reduce(np.add, map(part, here))
        return
    blocks = packed.rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield lambda part: blocks.map(part).treeReduce(np.add)
    finally:
        blocks.unpersist()


def fitted(total: boosting.Total, cuts: list[np.ndarray]) -> Model:
    weight = boosting.balance(total, len(KINDS))
    chance = boosting.chances_total(total, cuts, len(KINDS), weight)
    trees = boosting.fit_total(total, cuts, lambda rows: (chance(rows), weight(rows)))
    return Model(trees, boosting.thresholds(total, trees, chance, len(KINDS), PRECISION))


def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For calibration, features, whether it is personal data (null: not known), and whether rewritten."""
    for batch in steps(batches):
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            mark = zlib.crc32((text if doc_id is None else str(doc_id)).encode())
            held = mark % CALIBRATION_SHARE == 0
            rng = np.random.default_rng(mark)
            found = list(strict(text))
            base = [s for s, good in found if good]
            for span, good in found:
                if good or not any(overlaps(span, b) for b in base):
                    out.append((held, features(text, span), good, False))
            for span in base:
                out += [(held, features(t, s), good, True) for t, s, good in rewritten(text, span, rng)]
            failed = {s for s, good in found if not good}
            for span in sorted(s for s in proposals(text) if not _touches(s, base)):
                out.append((held, features(text, span), False if span in failed else None, False))
        yield pa.record_batch(
            [
                pa.array([o[0] for o in out], pa.bool_()),
                pa.array([o[1] for o in out], pa.list_(pa.float64())),
                pa.array([o[2] for o in out], pa.bool_()),
                pa.array([o[3] for o in out], pa.bool_()),
            ],
            ["held", "x", "y", "made"],
        )


def cuts_of(found: DataFrame) -> list[np.ndarray]:
    """Cuts of each feature: the quantiles within each kind of the examples that are not held back."""
    kind = F.array_position(F.slice("x", 1, len(KINDS)), F.lit(1.0))
    values = found.where("NOT held").select(kind.alias("kind"), F.posexplode("x").alias("f", "v"))
    counts = values.groupBy("kind", "f", "v").agg(F.count("*").alias("n"))
    of = Window.partitionBy("kind", "f")
    counts = counts.withColumns({"upto": F.sum("n").over(of.orderBy("v")), "all": F.sum("n").over(of)})
    crossed = f"least({boosting.BINS} * upto div `all`, {boosting.BINS - 1}) > {boosting.BINS} * (upto - n) div `all`"
    kept = counts.where(f"upto = n OR {crossed}").groupBy("f").agg(F.collect_set("v")).collect()
    cuts = dict(map(tuple, kept))
    return [np.array(sorted(cuts.get(f, [0.0]))) for f in range(len(features("", (0, 0, 0))))]


def blocks_of(found: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """The different examples and their number ``n``, in blocks: of each its marks, its kind and its bins, in bytes."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, y, made = (np.array(batch.column(k).to_pylist(), dtype=object) for k in ("held", "y", "made"))
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
            marks = (y == True) + 2 * (y != None) + 4 * (held == True) + 8 * (made == True)  # noqa: E711, E712
            kinds = x[:, : len(KINDS)].argmax(axis=1)
            keys = np.column_stack([marks.astype(np.uint8), kinds.astype(np.uint8), boosting.binned(x, cuts)])
            yield pa.record_batch([pa.array([k.tobytes() for k in keys], pa.binary())], ["key"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                keys, n = b"".join(part.column("key").to_pylist()), np.array(part.column("n").to_pylist(), np.int64)
                yield pa.record_batch([pa.array([keys], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["keys", "n"])

    counts = found.mapInArrow(bins, "key binary").groupBy("key").agg(F.count("*").alias("n"))
    return counts.mapInArrow(packed, "keys binary, n binary")


def block(row: Row) -> boosting.Rows:
    n = np.frombuffer(bytes(row["n"]), np.int64).astype(float)
    keys = np.frombuffer(bytes(row["keys"]), np.uint8).reshape(len(n), -1)
    right, known, held, made = (keys[:, 0] >> k & 1 == 1 for k in range(4))
    return boosting.Rows(keys[:, 2:], n, right, known, held, keys[:, 1].astype(int), right & made)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for k, start, end in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are one."""
    out, at = [], 0
    for k, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[k]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans, redacted`` of every row.

    ``base`` and ``spans`` list ``kind:start:end`` in code points (end exclusive), by kind and start, the
    counts are those of base spans. Null and empty texts have none. Rows are judged alone; a span is inside
    one row. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", "redacted"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = batch.column(1).to_pylist()
            found = [shared.value.spans(t) for t in texts]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            yield pa.record_batch(
                [
                    batch.column(0),
                    *counts,
                    pa.array([listed(base) for base, _ in found], pa.string()),
                    pa.array([listed(spans) for _, spans in found], pa.string()),
                    pa.array([redact(t, spans) for t, (_, spans) in zip(texts, found, strict=True)], pa.string()),
                ],
                names,
            )

    counted = ", ".join(f"n_{k} bigint" for k in KINDS)
    return id_and_text(docs).mapInArrow(
        search, f"doc_id bigint, {counted}, base string, spans string, redacted string"
    )

"""Operator 9: scoring by a hierarchical Pitman-Yor language model.

The hierarchy has a restaurant for every context, which is the previous word (or the start of a text); above them one
restaurant for words, whose customers are the tables of all contexts; and above it one for every context of up to
``ORDER`` letters: a table in the word restaurant is a word spelled once. A table in the
restaurant of a letter context is a customer in that of the context without its first letter, which all longer contexts
with this ending share; the parent of the empty context is uniform. Seatings are sampled by Gibbs, each round drawing all
table counts anew from their law given the parents (see ``pitman_yor``), and the predictive probabilities of the last
samples are averaged. As in the add-one score, all words that were never learned are one outcome, with the probability
of all their spellings together.

How it is spread out:

1. Rows are read once. Each task turns its rows into word numbers of a vocabulary of its own (a chunk) and
   sends the vocabulary with its training counts, split by hash, to buckets of words, which answer with each word's
   number in them. Then it sends each word's contexts, as numbers of words, with their counts.
2. A bucket holds its words' counts over all chunks. A frequent word is one number for each chunk and at most one
   for each chunk and context. Contexts lie across buckets, so no context's restaurant is in one place: its number
   of tables is a sum over buckets, formed by the owner of the context's bucket and sent to those that ask for it.
3. A word seen once after a context has one table there for certain. So between rounds buckets send, and ask for,
   the tables of contexts that some word of theirs was seen after repeatedly.
4. Nothing is kept of a seating. A draw depends on a seed and on sums over all buckets (tables by context, tables of
   words, spelled letters), so a task that needs the seating of a round repeats the rounds before it.
5. The letter model has at most SYMBOLS**4 entries whatever the corpus is: letters, an end, and two half-byte
   symbols for any other byte. Its counts are summed by Spark and its restaurants sampled on the driver.
6. Buckets answer each chunk with what is known of its words and their contexts, and chunks sum up their rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import id_and_text, steps, written
from voltlake.llm.pitman_yor import THETA, discount_of, draw_tables

FOLDS, HELD_OUT = 7, 2
ORDER = 3
END, PAD, SYMBOLS = 26, 43, 44
#: A chunk is closed at so many different words or tokens.
CHUNK_WORDS = 300_000
CHUNK_TOKENS = 3_000_000
#: Buckets for each shuffle partition.
BUCKETS = 2
#: Rounds of sampling, and how many at the end are averaged.
ROUNDS, SAMPLES = 3, 2
RNG_SEED = 20250101

# Two symbols for a byte that is no lower-case letter, one for a letter; the blank between words ends one
# word and pads the start of the next.
SPELLING = [
    [END] + [PAD] * ORDER if b == 32 else [b - 97] if 97 <= b < 123 else [27 + (b >> 4), 27 + (b & 15)]
    for b in range(256)
]
SPELLED = np.array([len(s) for s in SPELLING])
FLAT = np.array([s + [0] * (4 - len(s)) for s in SPELLING])


def pack(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes and so on: most of the higher ones are zero."""
    data = np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(values.size, values.itemsize)
    return zstandard.compress(data.T.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    values = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    return values.reshape(size, len(values) // size).T.copy().reshape(-1).view(kind)


def letter_grams(words: bytes) -> tuple[np.ndarray, np.ndarray]:
    """ORDER + 1 symbols (as one number) for every symbol of blank-separated words, and where words end."""
    data = np.frombuffer(words + b" ", dtype=np.uint8)
    sizes = SPELLED[data]
    at = np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols = FLAT[np.repeat(data, sizes), np.arange(len(at)) - at]
    symbols = np.concatenate([np.full(ORDER, PAD), symbols[:-ORDER]])
    count = len(symbols) - ORDER
    grams = np.zeros(count, dtype=np.int64)
    for k in range(ORDER + 1):
        grams = grams * SYMBOLS + symbols[k : k + count]
    own = symbols[ORDER:]
    grams = grams[own != PAD]
    return grams, np.flatnonzero(own[own != PAD] == END)


def spelling_log2(words: bytes, table: np.ndarray) -> np.ndarray:
    """log2 of each word's probability under a table of log2 letter probabilities."""
    grams, ends = letter_grams(words)
    total = np.concatenate([[0.0], np.cumsum(table[grams], dtype=np.float64)])
    return np.diff(total[np.concatenate([[0], ends + 1])])


class LetterModel:
    """Restaurants of all letter contexts, sampled from the symbols that word tables have spelled."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, rng: np.random.Generator):
        self.rng = rng
        self.codes: list[np.ndarray] = []
        self.into: list[np.ndarray] = []
        codes = grams
        for order in range(ORDER, -1, -1):
            self.codes.insert(0, codes)
            shorter = codes % SYMBOLS**order
            codes, into = np.unique(shorter, return_inverse=True)
            self.into.insert(0, into)
        self.customers = counts.astype(np.int64)
        self.discounts = [0.5] * (ORDER + 1)
        self.tables = [np.ones(len(c), dtype=np.int64) for c in self.codes]
        self._settle()

    def _counts(self, order: int) -> np.ndarray:
        if order == ORDER:
            return self.customers
        above = order + 1
        return np.bincount(self.into[above], weights=self.tables[above], minlength=len(self.codes[order])).astype(
            np.int64
        )

    def _settle(self) -> None:
        """Predictive probabilities of all orders but the longest, from the empty context up."""
        p = np.full((1, SYMBOLS), 1 / (SYMBOLS - 1))
        p[0, PAD] = 0
        self.parents = [p]
        for order in range(ORDER):
            self.parents.append(self._predictive(order, np.float64))

    def _predictive(self, order: int, kind: type) -> np.ndarray:
        parent, codes, t, d = self.parents[order], self.codes[order], self.tables[order], self.discounts[order]
        c = self._counts(order)
        contexts = SYMBOLS**order
        context = codes // SYMBOLS
        seated = np.bincount(context, weights=c, minlength=contexts)
        tables = np.bincount(context, weights=t, minlength=contexts)
        p = np.tile(parent.astype(kind), (contexts // len(parent), 1))
        p *= ((THETA + d * tables) / (THETA + seated)).astype(kind)[:, None]
        p.reshape(-1)[codes] += (c - d * t) / (THETA + seated[context])
        return p

    def longest(self) -> np.ndarray:
        """Predictive probabilities of every ORDER + 1 symbols."""
        return self._predictive(ORDER, np.float32).reshape(-1)

    def sweep(self) -> None:
        """Sample all seatings once, longest contexts first."""
        for order in range(ORDER, -1, -1):
            codes, c = self.codes[order], self._counts(order)
            d = self.discounts[order] = discount_of(c)
            context = codes // SYMBOLS
            tables = np.bincount(context, weights=self.tables[order], minlength=SYMBOLS**order)
            parent = self.parents[order]
            others = np.maximum(tables[context] - self.tables[order], 0)
            mass = (THETA + d * others) * parent[context % len(parent), codes % SYMBOLS]
            self.tables[order] = draw_tables(c, mass, d, self.rng)
        self._settle()


def letter_table(grams: np.ndarray, n: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """log2 probabilities of every ORDER + 1 symbols, averaged over samples; at most SYMBOLS**4 entries."""
    order = np.argsort(grams)
    model = LetterModel(grams[order], n[order], rng)
    model.sweep()
    mean = np.zeros(SYMBOLS ** (ORDER + 1), dtype=np.float32)
    for _ in range(SAMPLES):
        model.sweep()
        mean += model.longest()
    mean /= SAMPLES
    with np.errstate(divide="ignore"):
        return np.log2(mean, out=mean)


CHUNK_SCHEMA = (
    "chunk bigint, bucket int, words binary, counts binary, "
    "doc_ids array<bigint>, held array<boolean>, sizes array<int>, tokens binary"
)


def context_of(words: np.ndarray) -> np.ndarray:
    """Context that a word is to the word after it, both as numbers of words: itself."""
    return words


def numbered(bucket: np.ndarray | int, places: np.ndarray) -> np.ndarray:
    """Numbers of words, by bucket and place in it."""
    return np.asarray(bucket, dtype=np.int64) << 32 | places.astype(np.int64)


def by_bucket(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, slice]]:
    """Buckets, places in them and where they are, of word numbers grouped by bucket."""
    found, starts = np.unique(numbers >> 32, return_index=True)
    for k, lo, hi in zip(found.tolist(), starts, np.append(starts, len(numbers))[1:], strict=True):
        yield k, (numbers[lo:hi] & 0xFFFFFFFF).astype("<u4"), slice(lo, hi)


def token_pairs(places: np.ndarray, contexts: np.ndarray, start: int, n: int) -> np.ndarray:
    """Word and context (of ``n``) of each token as one number; ``start`` is the place of the end, which comes before a
    text."""
    before = np.concatenate([[start], places[:-1]])
    return places.astype(np.int64) * n + contexts[before]


def rows_of(schema: str, rows: list[dict]) -> pa.Table:
    """An Arrow table of a Spark schema; what a row lacks is null."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    kinds |= {"array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<int>": pa.list_(pa.int32())}
    columns = [column.strip().split(" ") for column in schema.split(",")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in columns})


def chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Chunks of rows: one row with the rows' word numbers, and one for each bucket of their words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        state: dict = {}

        def clear() -> None:
            vocabulary: defaultdict = defaultdict()
            vocabulary.default_factory = vocabulary.__len__
            vocabulary[b""]
            state.update(vocabulary=vocabulary, doc_ids=[], held=[], tokens=[], size=0)

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(state["vocabulary"])
            tokens = np.concatenate(state["tokens"])
            sizes = [len(x) for x in state["tokens"]]
            learned = ~np.repeat(np.array(state["held"]), sizes)
            counts = np.bincount(tokens[learned], minlength=len(words))
            bucket = np.array([zlib.crc32(w) for w in words], dtype=np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), dtype=np.uint32)
            place[order] = np.arange(len(words))
            chunk = part << 24 | number
            found, starts = np.unique(bucket[order], return_index=True)
            for k, lo, hi in zip(found, starts, [*starts[1:], len(words)], strict=True):
                own = order[lo:hi]
                packed = zstandard.compress(b" ".join([words[i] for i in own]), 1)
                row = {"chunk": chunk, "bucket": int(k), "words": packed, "counts": pack(counts[own])}
                yield from rows_of(CHUNK_SCHEMA, [row]).to_batches()
            bag = {"chunk": chunk, "doc_ids": state["doc_ids"], "held": state["held"], "sizes": sizes}
            yield from rows_of(CHUNK_SCHEMA, [bag | {"tokens": pack(place[tokens])}]).to_batches()

        clear()
        for batch in steps(batches):
            for doc_id, held, text in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(2), batch.column(1))), strict=True):
                words = text.encode().lower().split()
                ids = np.fromiter(map(state["vocabulary"].__getitem__, words), dtype=np.uint32, count=len(words))
                state["tokens"].append(np.append(ids, np.uint32(0)))
                state["doc_ids"].append(doc_id)
                state["held"].append(held)
                state["size"] += len(ids) + 1
                if len(state["vocabulary"]) >= CHUNK_WORDS or state["size"] >= CHUNK_TOKENS:
                    yield from rows()
                    number += 1
                    clear()
        if state["doc_ids"]:
            yield from rows()

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT
    return id_and_text(docs).withColumn("held", held).mapInArrow(read, CHUNK_SCHEMA)


WORDS_SCHEMA = "bucket int, chunk bigint, places binary, words binary, counts binary, n bigint, v bigint"


def merge_words(table: pa.Table) -> pa.Table:
    """The words of a bucket with their counts over all chunks, frequent ones first, and where each chunk's are in it."""
    vocabulary: defaultdict = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    bucket = table["bucket"][0].as_py()
    places, counts = [], []
    for row in table.select(["words", "counts"]).to_batches(1):
        words, n = (row.column(k)[0].as_py() for k in range(2))
        own = zstandard.decompress(words).split(b" ")
        places.append(np.fromiter(map(vocabulary.__getitem__, own), dtype=np.uint32, count=len(own)))
        counts.append(unpack(n, "<i8"))
    total = np.zeros(len(vocabulary), dtype=np.int64)
    for at, n in zip(places, counts, strict=True):
        total[at] += n  # a chunk names a word once
    words = list(vocabulary)
    order = np.array(sorted(range(len(words)), key=lambda i: (-total[i], words[i])))
    place = np.empty(len(words), dtype="<u4")
    place[order] = np.arange(len(words))
    rows = [
        {"bucket": bucket, "chunk": chunk, "places": pack(place[at])}
        for chunk, at in zip(table["chunk"].to_pylist(), places, strict=True)
    ]
    whole = {
        "bucket": bucket,
        "words": zstandard.compress(b" ".join([words[i] for i in order]), 1),
        "counts": pack(total[order]),
        "n": int(total.sum()),
        "v": int((total > 0).sum()),
    }
    return rows_of(WORDS_SCHEMA, [*rows, whole])


#: What a chunk asks a bucket: its words' places, of each the contexts (as numbers of words) and their training counts,
#: and the places of contexts of the bucket; null if these are those of the words.
ASKED_SCHEMA = (
    "bucket int, chunk bigint, places binary, context_places binary, "
    "pair_sizes binary, pair_contexts binary, pair_counts binary"
)

#: Of that, what its answer needs.
ASKED = ("bucket", "chunk", "places", "context_places", "pair_sizes", "pair_contexts")
#: Contexts after which a word was seen once, and those after which it was repeatedly, with their counts.
PAIRS = ("once_sizes", "once_contexts", "again_sizes", "again_contexts", "again_counts")
BUCKET_SCHEMA = (
    "bucket int, chunk bigint, places binary, context_places binary, pair_sizes binary, pair_contexts binary, "
    "words binary, counts binary, " + ", ".join(f"{name} binary" for name in PAIRS)
)


def merge_pairs(table: pa.Table) -> pa.Table:
    """The words of a bucket with their contexts over all chunks, and what chunks ask for without its counts."""
    rows, whole = [], {"words": None}
    words, contexts, counts = ([np.zeros(0, dtype=np.int64)] for _ in range(3))
    for batch in table.to_batches(1):
        row = batch.to_pylist()[0]
        if row["chunk"] is None:
            whole = row
            continue
        learned = unpack(row["pair_counts"], "<u4")
        places = np.repeat(unpack(row["places"], "<u4").astype(np.int64), unpack(row["pair_sizes"], "<u4"))
        words.append(places[learned > 0])
        contexts.append(unpack(row["pair_contexts"], "<i8")[learned > 0])
        counts.append(learned[learned > 0].astype(np.int64))
        rows.append({name: row[name] for name in ASKED})
    if whole["words"] is not None:
        size = len(unpack(whole["counts"], "<i8"))
        names, context = np.unique(np.concatenate(contexts), return_inverse=True)
        keys, which = np.unique(np.concatenate(words) * max(len(names), 1) + context, return_inverse=True)
        n = np.bincount(which, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)
        word, context = keys // max(len(names), 1), names[keys % max(len(names), 1)]
        packed = {"bucket": whole["bucket"], "words": whole["words"], "counts": whole["counts"]}
        for name, those in (("once", n == 1), ("again", n > 1)):
            packed[f"{name}_sizes"] = pack(np.bincount(word[those], minlength=size).astype("<u4"))
            packed[f"{name}_contexts"] = pack(context[those])
        rows.append(packed | {"again_counts": pack(n[n > 1])})
    return rows_of(BUCKET_SCHEMA, rows)


@dataclass
class Totals:
    """Sums over all buckets after a round: what the draws of the next one, and predictions, depend on."""

    tables: float
    customers: float
    discount: float
    #: Probability of all learned words together by the letters of the round.
    spelled: float = 0.0


class Bucket:
    """The words of a bucket, with the table counts of the rounds repeated so far.

    Only the tables of pairs seen repeatedly are drawn; pairs seen once have one.
    """

    def __init__(self, row: dict):
        self.number = row["bucket"]
        self.words = zstandard.decompress(row["words"])
        self.counts = unpack(row["counts"], "<i8")
        self.once = unpack(row["once_sizes"], "<u4").astype(np.int64)
        again = unpack(row["again_sizes"], "<u4").astype(np.int64)
        self.pair_counts = unpack(row["again_counts"], "<i8")
        self.word = np.repeat(np.arange(len(again)), again)
        self.contexts, self.context = np.unique(unpack(row["again_contexts"], "<i8"), return_inverse=True)
        self.once_contexts = None if row.get("once_contexts") is None else unpack(row["once_contexts"], "<i8")
        self.seated = np.ones(len(self.word), dtype=np.int64)
        self.customers = self.once + again
        self.tables = np.minimum(self.customers, 1)
        self.spelled = np.zeros(len(again))

    def draw(
        self, round_: int, letters: np.ndarray, discount: float, totals: Totals, context_tables: np.ndarray
    ) -> None:
        """The tables of contexts given those of words, then the tables of words given their spelling.

        The own tables of what is drawn are taken out of the sums, and out of its word in proportion.
        """
        rng = np.random.default_rng([RNG_SEED, round_, self.number])
        self.spelled = np.exp2(spelling_log2(self.words, letters))
        opened = (THETA + totals.discount * totals.tables) * self.spelled
        others = self.customers[self.word] - self.seated
        kept = others * (1 - totals.discount * self.tables[self.word] / self.customers[self.word])
        parent = (np.maximum(kept, 0) + opened[self.word]) / (THETA + totals.customers - self.seated)
        mass = (THETA + discount * (context_tables[self.context] - self.seated)) * parent
        self.seated = draw_tables(self.pair_counts, mass, discount, rng)
        again = np.bincount(self.word, weights=self.seated, minlength=len(self.counts)).astype(np.int64)
        self.customers = self.once + again
        free = np.maximum(totals.tables - self.tables, 0)
        self.tables = draw_tables(self.customers, (THETA + totals.discount * free) * self.spelled, totals.discount, rng)

    def probability(self, discount: float, after: Totals) -> np.ndarray:
        """Of each word in the word restaurant, with the sums after the round."""
        opened = (THETA + discount * after.tables) * self.spelled
        return (self.customers - discount * self.tables + opened) / (THETA + after.customers)

    def all_contexts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All contexts, with the number of their words here and of these words' occurrences."""
        contexts = np.concatenate([self.contexts[self.context], self.once_contexts])
        found, at = np.unique(contexts, return_inverse=True)
        counts = np.concatenate([self.pair_counts, np.ones(len(self.once_contexts), dtype=np.int64)])
        n = np.bincount(at, weights=counts, minlength=len(found)).astype(np.int64)
        return found, np.bincount(at, minlength=len(found)), n


#: Keys of summed values: grams from 0 up; below, single numbers.
SINGLE = ("customers", "tables", "ones", "twos", "spelled", "pair_ones", "pair_twos")

#: Sums over buckets, as keys and values, and messages to the buckets of contexts.
STEP_SCHEMA = (
    "key bigint, value double, owner int, sender int, wanted int, contexts binary, tables binary, tokens binary"
)
TABLES_SCHEMA = "bucket int, round int, sender int, places binary, tables binary, tokens binary"
#: Buckets are put together in owners of about so many learned words, which sum up the tables of contexts.
OWNED_WORDS = 50_000


def owner_of(contexts: np.ndarray, owners: int) -> np.ndarray:
    return (contexts >> 32) % owners


def replayed(rows: list[dict], owners: int, discount: float, rounds: list) -> Iterator[Bucket]:
    """The bucket before the first of ``rounds`` and after each of them.

    ``rows`` are the bucket's words and, for each round, the tables that it asked for.
    """
    own = Bucket(next(r for r in rows if r["words"] is not None))
    yield own
    for number, (letters, totals) in enumerate(rounds):
        told = [r for r in rows if r.get("round") == number and r["sender"] is not None]
        told.sort(key=lambda r: r["sender"])
        tables = np.zeros(len(own.contexts), dtype="<i8")
        order = np.lexsort((own.contexts, owner_of(own.contexts, owners)))
        tables[order] = np.concatenate([tables[:0], *[unpack(r["tables"], "<i8") for r in told]])
        own.draw(number, letters.value, discount, totals, tables)
        yield own


def step(rows: list[dict], owners: int, discount: float, rounds: list) -> pa.Table:
    """Repeat ``rounds`` in a bucket: what it adds to the sums, and what it tells the owners of contexts."""
    for own in replayed(rows, owners, discount, rounds):
        pass
    grams, ends = letter_grams(own.words)
    times = np.repeat(own.tables, np.diff(np.concatenate([[0], ends + 1])))
    found, at = np.unique(grams, return_inverse=True)
    n = np.bincount(at, weights=times, minlength=len(found))
    single = [
        own.customers.sum(), own.tables.sum(), (own.customers == 1).sum(), (own.customers == 2).sum(),
        own.spelled[own.counts > 0].sum(), own.once.sum(), (own.pair_counts == 2).sum(),
    ]
    keys = np.concatenate([found[n > 0], -1 - np.arange(len(single))])
    sums = pa.table({"key": pa.array(keys, pa.int64()), "value": np.concatenate([n[n > 0], single])})
    if rounds:
        # Beyond the one table of each word that is known from the first step.
        contexts, wanted = own.contexts, np.ones(len(own.contexts), dtype=bool)
        tables = np.bincount(own.context, weights=own.seated - 1, minlength=len(contexts)).astype(np.int64)
        tokens = None
    else:
        contexts, tables, tokens = own.all_contexts()
        wanted = np.isin(contexts, own.contexts)
    owner = owner_of(contexts, owners)
    order = np.lexsort((contexts, ~wanted, owner))
    found, starts = np.unique(owner[order], return_index=True)
    messages = []
    for k, lo, hi in zip(found.tolist(), starts, np.append(starts, len(order))[1:], strict=True):
        mine = order[lo:hi]
        messages.append(
            {
                "owner": k,
                "sender": own.number,
                "wanted": 0 if len(rounds) == ROUNDS else int(wanted[mine].sum()),
                "contexts": pack(contexts[mine]),
                "tables": pack(tables[mine].astype("<i8")),
                "tokens": None if tokens is None else pack(tokens[mine]),
            }
        )
    return pa.concat_tables([rows_of(STEP_SCHEMA, messages), sums], promote_options="default")


def add_tables(table: pa.Table, number: int) -> pa.Table:
    """The tables of all contexts of an owner, by bucket, and replies to the buckets that want some of them."""
    owner, rows = table["owner"][0].as_py(), table.to_pylist()
    told = [r for r in rows if r["sender"] is not None]
    known = [r for r in rows if r["sender"] is None]
    numbers = [unpack(r["contexts"], "<i8") for r in told]
    numbers += [numbered(r["bucket"], unpack(r["places"], "<u4")) for r in known]
    names, at = np.unique(np.concatenate(numbers), return_inverse=True)

    def total(name: str, those: list[dict]) -> np.ndarray:
        values = np.concatenate([unpack(r[name], "<i8") for r in those])
        return np.bincount(at, weights=values, minlength=len(names)).astype("<i8")

    tables = total("tables", told + known)
    tokens = total("tokens", told) if number == 0 else None
    replies, start = [], 0
    for r, own in zip(told, numbers, strict=False):
        if r["wanted"]:
            values = pack(tables[at[start : start + r["wanted"]]])
            replies.append({"bucket": r["sender"], "round": number, "sender": owner, "tables": values})
        start += len(own)
    for k, places, mine in by_bucket(names):
        row = {"bucket": k, "round": number, "places": pack(places), "tables": pack(tables[mine])}
        replies.append(row | {"tokens": None if tokens is None else pack(tokens[mine])})
    return rows_of(TABLES_SCHEMA, replies)


def summed(rows: DataFrame) -> tuple[dict[str, float], tuple[np.ndarray, np.ndarray]]:
    """Single numbers, and letter grams with their counts: at most SYMBOLS**4 + 7 numbers reach the driver, as arrays."""
    found = rows.where("key IS NOT NULL").groupBy("key").agg(F.sum("value").alias("value")).toArrow()
    keys, values = found["key"].to_numpy(), found["value"].to_numpy()
    below = np.zeros(len(SINGLE))
    below[-1 - keys[keys < 0]] = values[keys < 0]
    return dict(zip(SINGLE, below.tolist(), strict=True)), (keys[keys >= 0], values[keys >= 0].astype(np.int64))


def word_discount(single: dict[str, float]) -> float:
    return discount_of(np.array([1, 2]), np.array([single["ones"], single["twos"]]))


ANSWER_SCHEMA = (
    "chunk bigint, bucket int, places binary, context_places binary, "
    "counts binary, means binary, pairs binary, seats binary"
)


def answer(table: pa.Table, owners: int, discount: float, rounds: list, after: list[Totals]) -> pa.Table:
    """What a bucket tells its chunks: of each word the count and, by sample, the probability; of each word and context
    the count and, by sample, the tables; of each context the tokens and, by sample, the tables."""
    asked = table.filter(pc.is_valid(table["chunk"]))
    rows = table.filter(pc.is_null(table["chunk"])).to_pylist()
    probability, seated = [], []
    for number, own in enumerate(replayed(rows, owners, discount, rounds)):
        if number > ROUNDS - SAMPLES:
            probability.append(own.probability(rounds[number - 1][1].discount, after[number - 1]).astype("<f4"))
            seated.append(own.seated)
    ones = np.ones(len(own.once_contexts), dtype=np.int64)
    names, context = np.unique(np.concatenate([own.contexts[own.context], own.once_contexts]), return_inverse=True)
    keys = np.concatenate([own.word, np.repeat(np.arange(len(own.once)), own.once)]) * max(len(names), 1) + context
    order = np.argsort(keys)
    keys = keys[order]
    known = np.stack([np.concatenate([x, ones])[order] for x in (own.pair_counts, *seated)])
    known = np.append(known, np.zeros((1 + SAMPLES, 1), dtype=np.int64), axis=1)
    # Contexts without a message have no tables.
    seats = np.zeros((1 + SAMPLES, len(own.counts)), dtype="<i8")
    for r in rows:
        if r["words"] is None and r["sender"] is None:
            sample = r["round"] - (ROUNDS - SAMPLES)
            for k, name in ((0, "tokens"),) if r["round"] == 0 else ((sample, "tables"),) if sample > 0 else ():
                seats[k, unpack(r["places"], "<u4")] = unpack(r[name], "<i8")
    replies = []
    for batch in asked.to_batches(1):
        row = batch.to_pylist()[0]
        places, sizes = unpack(row["places"], "<u4"), unpack(row["pair_sizes"], "<u4")
        contexts = unpack(row["pair_contexts"], "<i8")
        at = np.searchsorted(names, contexts)
        there = at < len(names)
        there[there] = names[at[there]] == contexts[there]
        wanted = np.repeat(places.astype(np.int64), sizes) * max(len(names), 1) + at
        at = np.searchsorted(keys, wanted)
        there &= at < len(keys)
        there[there] = keys[at[there]] == wanted[there]
        named = np.sort(places) if row["context_places"] is None else unpack(row["context_places"], "<u4")
        replies.append(
            {
                **{name: row[name] for name in ("chunk", "bucket", "places", "context_places")},
                "counts": pack(own.counts[places]),
                "means": pack(np.stack(probability)[:, places]),
                "pairs": pack(known[:, np.where(there, at, len(keys))].astype("<u4")),
                "seats": pack(seats[:, named]),
            }
        )
    return rows_of(ANSWER_SCHEMA, replies)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens: words (A-Z lower-cased, split at ASCII white space) and one end. Rows whose crc32(doc_id) leaves
    the remainder HELD_OUT are scored but not learned from; a null doc_id counts as an empty string and is
    learned from. ``base_score`` is the add-one score of single words, ``score`` that of the model, each word given the
    one before it, both log10. Null and empty texts are an end alone. Without rows to learn from every token is the one unknown
    outcome, so both scores are 0. Repeated rows count again. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = written(chunks(docs, buckets), "lm-chunks")
    requests = read.where("bucket IS NOT NULL").select("chunk", "bucket", "words", "counts")
    vocabulary = written(requests.groupBy("bucket").applyInArrow(merge_words, WORDS_SCHEMA), "lm-words")
    n, v = (x or 0 for x in vocabulary.agg(F.sum("n"), F.sum("v")).first())
    owners = min(buckets, v // OWNED_WORDS + 1)

    def pairs_of(replies: pa.Table, bags: pa.Table) -> pa.Table:
        replies = replies.sort_by("at_bucket").to_pylist()
        ids = np.concatenate([numbered(r["at_bucket"], unpack(r["places"], "<u4")) for r in replies])
        row = bags.slice(0, 1).to_pylist()[0]
        tokens, sizes = unpack(row["tokens"], "<u4"), np.array(row["sizes"])
        contexts, context = np.unique(context_of(ids), return_inverse=True)
        pairs, which = np.unique(
            token_pairs(tokens, context, int(tokens[sizes[0] - 1]), len(contexts)), return_inverse=True
        )
        learned = ~np.repeat(np.array(row["held"]), sizes)
        counts = np.bincount(which[learned], minlength=len(pairs)).astype("<u4")
        pair_sizes = np.bincount(pairs // len(contexts), minlength=len(ids)).astype("<u4")
        ends = np.concatenate([[0], np.cumsum(pair_sizes, dtype=np.int64)])
        named = {k: places for k, places, _ in by_bucket(contexts)}
        own = {k: (places, mine) for k, places, mine in by_bucket(ids)}
        nothing = np.zeros(0, dtype="<u4")
        rows = []
        for k in sorted(named.keys() | own.keys()):
            places, mine = own.get(k, (nothing, slice(0, 0)))
            its = slice(ends[mine.start], ends[mine.stop])
            same = np.array_equal(np.sort(places), named.get(k, nothing))
            rows.append(
                {
                    "bucket": k,
                    "chunk": row["chunk"],
                    "places": pack(places),
                    "context_places": None if same else pack(named.get(k, nothing)),
                    "pair_sizes": pack(pair_sizes[mine]),
                    "pair_contexts": pack(contexts[pairs[its] % len(contexts)]),
                    "pair_counts": pack(counts[its]),
                }
            )
        return rows_of(ASKED_SCHEMA, rows)

    # Names of their own, as the columns of both sides of the cogroup are those of one table.
    places = vocabulary.where("chunk IS NOT NULL").select("chunk", "bucket", "places")
    places = places.toDF("of_chunk", "at_bucket", "places")
    bags = read.where("bucket IS NULL").select("chunk", "doc_ids", "held", "sizes", "tokens")
    asked = places.groupBy("of_chunk").cogroup(bags.drop("doc_ids").groupBy("chunk")).applyInArrow(pairs_of, ASKED_SCHEMA)
    asked = asked.unionByName(
        vocabulary.where("chunk IS NULL").select("bucket", "words", "counts"), allowMissingColumns=True
    )
    merged = written(asked.groupBy("bucket").applyInArrow(merge_pairs, BUCKET_SCHEMA), "lm-buckets")
    words = merged.where("chunk IS NULL").select("bucket", "words", "counts", *PAIRS)

    def first_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from step(batch.slice(k, 1).to_pylist(), owners, 0.5, []).to_batches()

    def exchanged(rows: DataFrame, number: int, types: DataFrame | None) -> DataFrame:
        told = rows.where("key IS NULL").drop("key", "value")
        if types is not None:
            of = types.select((F.col("bucket") % owners).alias("owner"), "bucket", "places", "tables")
            told = told.unionByName(of, allowMissingColumns=True)
        return written(
            told.groupBy("owner").applyInArrow(lambda table: add_tables(table, number), TABLES_SCHEMA), "lm-tables"
        )

    rng = np.random.default_rng(RNG_SEED)
    rows = written(words.mapInArrow(first_step, STEP_SCHEMA), "lm-sums")
    single, grams = summed(rows)
    pair_discount = discount_of(np.array([1, 2]), np.array([single["pair_ones"], single["pair_twos"]]))
    tables = exchanged(rows, 0, None)
    types = tables.where("sender IS NULL")
    rounds, after = [], []
    for number in range(1, ROUNDS + 1):
        totals = Totals(single["tables"], single["customers"], word_discount(single))
        rounds.append((spark.sparkContext.broadcast(letter_table(*grams, rng)), totals))
        state = words.drop("once_contexts").unionByName(
            tables.where("sender IS NOT NULL").drop("places", "tokens"), allowMissingColumns=True
        )
        # Written at once, so the rounds are those so far.
        rows = written(
            state.groupBy("bucket").applyInArrow(
                lambda table: step(table.to_pylist(), owners, pair_discount, rounds), STEP_SCHEMA
            ),
            "lm-sums",
        )
        single, grams = summed(rows)
        tables = tables.unionByName(exchanged(rows, number, types))
        after.append(Totals(single["tables"], single["customers"], totals.discount, single["spelled"]))

    answers = (
        merged.unionByName(tables, allowMissingColumns=True)
        .groupBy("bucket")
        .applyInArrow(lambda table: answer(table, owners, pair_discount, rounds, after), ANSWER_SCHEMA)
    )

    def add_up(replies: pa.Table, rows: pa.Table) -> pa.Table:
        replies = replies.sort_by("bucket").to_pylist()
        places = [unpack(r["places"], "<u4") for r in replies]
        named = [
            np.sort(at) if r["context_places"] is None else unpack(r["context_places"], "<u4")
            for r, at in zip(replies, places, strict=True)
        ]
        ids, contexts = (
            np.concatenate([numbered(r["bucket"], at) for r, at in zip(replies, parts, strict=True)])
            for parts in (places, named)
        )
        c = np.concatenate([unpack(r["counts"], "<i8") for r in replies])
        means, pairs, seats = (
            np.concatenate([unpack(r[name], kind).reshape(size, -1) if r[name] else np.zeros((size, 0)) for r in replies], axis=1)
            for name, kind, size in (("means", "<f4", SAMPLES), ("pairs", "<u4", 1 + SAMPLES), ("seats", "<i8", 1 + SAMPLES))
        )
        row = rows.slice(0, 1).to_pylist()[0]
        tokens = unpack(row["tokens"], "<u4")
        sizes = np.array(row["sizes"])
        first = np.cumsum(sizes) - sizes
        keys, which = np.unique(
            token_pairs(
                tokens, np.searchsorted(contexts, context_of(ids)), int(tokens[sizes[0] - 1]), len(contexts)
            ),
            return_inverse=True,
        )
        word, context = keys // len(contexts), keys % len(contexts)
        model = np.zeros(len(keys))
        for k, totals in enumerate(after[ROUNDS - SAMPLES :]):
            opened = (THETA + totals.discount * totals.tables) / (THETA + totals.customers)
            unknown = max(opened * (1 - totals.spelled), 1e-300)
            parent = np.where(c > 0, means[k], unknown)[word]
            own = np.maximum(pairs[0] - pair_discount * pairs[1 + k], 0)
            new = (THETA + pair_discount * seats[1 + k, context]) * parent
            model += (own + new) / (THETA + seats[0, context]) / SAMPLES
        model = np.log10(model)[which]
        base = np.log10((c + 1) / (n + (v + 1)))
        known = np.add.reduceat((c > 0)[tokens].astype(np.int64), first)
        return pa.table(
            [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["held"], pa.bool_()),
                pa.array(sizes, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(np.full(len(sizes), n), pa.int64()),
                pa.array(np.add.reduceat(base[tokens], first)),
                pa.array(np.add.reduceat(model, first)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return (
        answers.groupBy("chunk")
        .cogroup(bags.groupBy("chunk"))
        .applyInArrow(
            add_up,
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double",
        )
    )

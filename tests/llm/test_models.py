"""Language, language model, personal data and decontamination against brute force and held-out rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, prose, row
from voltlake.llm import boosting, decontaminate, language, lm, pii
from voltlake.llm.common import hash_sample
from voltlake.llm.pitman_yor import draw_tables, many
from voltlake.llm.queries import QUERIES


def held_out(doc_id, folds, rest):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == rest


# Language


def test_op10_on_held_out_rows(spark, sf):
    got = {r["doc_id"]: r for r in QUERIES["op10_language"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got.keys() == {r["doc_id"] for r in rows}
    assert all(got[r["doc_id"]]["held_out"] == held_out(r["doc_id"], 3, 1) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    held = [r for r in rows if held_out(r["doc_id"], 3, 1)]
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)


def brute_code_length(sample, text):
    """Prediction by partial matching, method C, straight from its definition."""
    counts = Counter()
    for t in sample:
        data = language.PAD + t.encode()
        for k in range(language.ORDER, len(data)):
            for order in range(language.ORDER + 1):
                counts[data[k - order : k], data[k]] += 1
    seen, kinds = Counter(), Counter()
    for (context, _), n in counts.items():
        seen[context] += n
        kinds[context] += 1
    total, data = 0.0, language.PAD + text.encode()
    for k in range(language.ORDER, len(data)):
        for order in range(language.ORDER, -1, -1):
            context = data[k - order : k]
            n, q, c = seen[context], kinds[context], counts[context, data[k]]
            if c:
                total += math.log2((n + q) / c)
                break
            if n:
                total += math.log2((n + q) / q)
        else:
            total += 8
    return total


def test_code_lengths_are_exact(spark):
    samples = {"en": [prose(1, 40), "the end"], "de": ["über den Fluß", "ich und du"]}
    ids = [k for k in range(100) if not held_out(k, 3, 1)]
    rows = [row(ids.pop(), t, lang) for lang, texts in samples.items() for t in texts]
    rows += [row(k, "never learned", "fr") for k in range(100) if held_out(k, 3, 1)]
    rows += [row(ids.pop(), "no label", None), row(ids.pop(), None, "es")]
    trees = language.learn(spark.createDataFrame(rows, SCHEMA))
    assert trees.languages == ["de", "en"]
    for text in ("the ring", "Fluß und über", "日本", "a"):
        want = [brute_code_length(samples[x], text) for x in trees.languages]
        assert trees.code_lengths([text.encode()])[0] == pytest.approx(want, rel=1e-9)


def test_slices_do_not_change_code_lengths(monkeypatch):
    gram = int.from_bytes(b"the ", "big")
    trees = language.ContextTrees({"en": {gram: 3, gram + 1: 1}})
    text = (prose(3, 200) + "the the the ").encode()
    whole = trees.code_lengths([text])
    assert trees.code_lengths([b"", text, text[:50]])[1] == pytest.approx(whole[0])
    monkeypatch.setattr(language, "SLICE", 7)
    assert trees.code_lengths([text]) == pytest.approx(whole)
    monkeypatch.setattr(language, "TABLE_CELLS", 0)
    searched = language.ContextTrees({"en": {gram: 3, gram + 1: 1}})
    assert searched.table is None and searched.code_lengths([text]) == pytest.approx(whole)


def test_signs_are_no_letters():
    texts = {"": False, "2² ½ Ⅷ _": False, "1a": True, "ß": True, "日": True, "🙂": False}
    assert {t: language.has_letter(t) for t in texts} == texts


def test_language_of_awkward_rows(awkward, nothing):
    got = Counter((r["doc_id"], r["lang_pred"]) for r in language.predictions(awkward).collect())
    letters = Counter(
        r["doc_id"] for r in awkward.collect() if not any(c.isalpha() for c in r["text"] or "")
    )
    assert Counter(i for (i, lang), n in got.items() if lang == "und" for _ in range(n)) == letters
    kept = language.drop_unidentified(awkward)
    assert kept.schema == awkward.schema
    assert kept.count() == awkward.count() - sum(letters.values())
    assert language.predictions(nothing).isEmpty() and language.drop_unidentified(nothing).isEmpty()


# Language model


def test_op9_base_scores_and_perplexity(spark, sf, plain):
    tokens = {i: [*t.encode().lower().split(), None] for i, t in plain}
    c = Counter(w for i, ws in tokens.items() if not held_out(i, 7, 2) for w in ws)
    n, v = sum(c.values()), len(c)
    got = QUERIES["op9_pitman_yor"](spark, sf).collect()
    assert len(got) == len(tokens)
    for r in got:
        words = tokens[r["doc_id"]]
        assert r["held_out"] == held_out(r["doc_id"], 7, 2) and r["train_tokens"] == n
        assert (r["n_tokens"], r["n_known"]) == (len(words), sum(c[w] > 0 for w in words))
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    again = {r["doc_id"]: r["score"] for r in QUERIES["op9_pitman_yor"](spark, sf).collect()}
    assert again == pytest.approx({r["doc_id"]: r["score"] for r in got})


def test_probabilities_sum_to_one(spark, monkeypatch):
    """Known words and the one unknown outcome share all probability: score every word as a text."""
    ids = [k for k in range(400) if not held_out(k, 7, 2)]
    held = [k for k in range(400, 4000) if held_out(k, 7, 2)]
    texts = [prose(k, 30) for k in range(20)]
    vocabulary = sorted({w for t in texts for w in t.split()})
    rows = [row(ids.pop(), t) for t in texts] + [row(held.pop(), w) for w in [*vocabulary, "unknown!", ""]]
    # With one context for all words, that is what an end costs after any word.
    monkeypatch.setattr(lm, "context_of", lambda hashes: hashes * 0)
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, SCHEMA)).collect()}
    end = got[rows[-1][0]]
    total = 10**end + sum(10 ** (got[r[0]] - end) for r in rows[len(texts) : -1])
    assert total == pytest.approx(1, abs=1e-6)


def test_every_previous_word_is_a_context_of_its_own(spark):
    """Two words whose hashes agree in the 10 bits that contexts were once told apart by."""
    bits: dict = {}
    for k in range(10_000):
        word = prose(k, 1).rstrip(".") + str(k)
        one = bits.setdefault((zlib.crc32(word.encode()) * 0x9E3779B1 & 0xFFFFFFFF) >> 22, word)
        if one != word:
            break
    ids = [k for k in range(400) if not held_out(k, 7, 2)]
    held = [k for k in range(400, 800) if held_out(k, 7, 2)][:4]
    rows = [row(ids.pop(), t) for t in [f"{one} left", f"{word} right"] * 20 + [prose(k, 30) for k in range(20)]]
    asked = [f"{one} left", f"{one} right", f"{word} left", f"{word} right"]
    rows += [row(k, t) for k, t in zip(held, asked, strict=True)]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, SCHEMA)).collect()}
    own, other, cross, same = (got[k] for k in held)
    assert own - other + same - cross > 1


def test_owners_of_contexts_make_no_difference(spark, monkeypatch):
    rows = spark.createDataFrame([row(k, prose(k % 40, 30)) for k in range(60)], SCHEMA)
    one = {r["doc_id"]: r["score"] for r in lm.score(rows).collect()}
    monkeypatch.setattr(lm, "OWNED_WORDS", 10)
    assert {r["doc_id"]: r["score"] for r in lm.score(rows).collect()} == pytest.approx(one)


def test_scores_of_awkward_rows(awkward, nothing):
    got = lm.score(awkward).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode().split()) + 1) for r in awkward.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert lm.score(nothing).isEmpty()


def test_nothing_to_learn_from(spark):
    held = [k for k in range(100) if held_out(k, 7, 2)][:3]
    got = lm.score(spark.createDataFrame([row(k, "a b") for k in held], SCHEMA)).collect()
    assert [(r["base_score"], r["score"], r["n_known"]) for r in got] == [(0, 0, 0)] * 3


def table_law(c, mass, d):
    """Probabilities of 1 to c tables by the recursion over generalized Stirling numbers."""
    log_s, t = np.full(c + 1, -np.inf), np.arange(1, c + 1)
    log_s[0] = 0
    for n in range(c):
        with np.errstate(divide="ignore"):
            stay = np.where(t <= n, np.log(np.maximum(n - t * d, 1e-300)) + log_s[1:], -np.inf)
        log_s[1:] = np.logaddexp(log_s[:-1], stay)
        log_s[0] = -np.inf
    weight = log_s[1:] + t * math.log(mass)
    weight = np.exp(weight - weight.max())
    return weight / weight.sum()


@pytest.mark.parametrize("d", [0.1, 0.5, 0.9])
@pytest.mark.parametrize("c", [2, 3, 100, 700, 10_000])
def test_table_counts_follow_their_law(c, d):
    rng = np.random.default_rng(1)
    for mass in (0.3, 10.0, 300.0):
        law, t = table_law(c, mass, d), np.arange(1, c + 1)
        mean = (law * t).sum()
        drawn = draw_tables(np.full(4_000, c), np.full(4_000, mass), d, rng)
        assert drawn.min() >= 1 and drawn.max() <= c
        assert drawn.mean() == pytest.approx(mean, rel=0.03)
        assert drawn.var() == pytest.approx((law * (t - mean) ** 2).sum(), rel=0.2, abs=0.05)


def test_table_counts_of_any_number_of_customers():
    rng = np.random.default_rng(2)
    assert draw_tables(np.array([0, 1, 1]), np.array([3.0, 0.0, 1e9]), 0.5, rng).tolist() == [0, 1, 1]
    assert draw_tables(np.array([], dtype=int), np.array([]), 0.5, rng).tolist() == []
    c = np.array([257, 10**4, 10**7, 10**10], dtype=float)
    for mass in (1e-9, 1.0, 1e3, 1e9):
        mean, variance = many(c, np.full(4, mass), 0.5)
        assert (mean >= 1).all() and (mean <= c).all() and (variance >= 0).all() and (np.diff(mean) >= 0).all()
    assert many(c[3:], np.array([10.0]), 0.5)[0] == pytest.approx(1 + 10 / 0.5, rel=1e-3)


def test_scores_of_words_that_were_seen_once_against_brute_force(spark, monkeypatch):
    """Every count is one, so every seating is certain; letters are all alike."""
    monkeypatch.setattr(lm, "letter_table", lambda grams, n, rng: np.full(lm.SYMBOLS**4, -math.log2(43), np.float32))
    words = [prose(k, 1).rstrip(".") + str(k) for k in range(30)]
    learned = [k for k in range(100) if not held_out(k, 7, 2)][:3]
    rows = [row(i, " ".join(words[10 * k : 10 * k + 10])) for k, i in enumerate(learned)]
    fresh = [k for k in range(100, 200) if held_out(k, 7, 2)][:4]
    shuffled = [words[k] for k in (7, 3, 21, 4, 5, 6, 28, 0, 11, 12)]
    rows += [row(i, t) for i, t in zip(fresh, [" ".join(words[:10]), " ".join(shuffled), "", words[4] + " new"], strict=True)]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, SCHEMA)).collect()}

    texts = {r[0]: [*r[1].split(), ""] for r in rows}
    context = lambda w: int(lm.context_of(np.array([zlib.crc32(w.encode())], dtype=np.int64))[0])
    pairs = Counter((context(x), w) for i in learned for x, w in zip(["", *texts[i]], texts[i]))
    assert set(pairs.values()) == {1}
    tokens = Counter(x for x, _ in pairs.elements())
    tables = Counter(x for x, _ in pairs)
    customers = Counter(w for _, w in pairs)
    spell = lambda w: 43.0 ** -(sum(1 if c.isalpha() else 2 for c in w) + 1)
    n1, n2 = (sum(v == k for v in customers.values()) for k in (1, 2))
    d = {1: 0.9, 0: round(min(n1 / (n1 + 2 * n2), 0.9), 2)}
    theta, total = 1.0, sum(customers.values())
    ends = customers[""]  # the only word with several customers: its tables are drawn

    def word(w, end_tables):
        free = (theta + d[0] * (len(customers) - 1 + end_tables)) / (theta + total)
        t = end_tables if w == "" else 1
        if w in customers:
            return (customers[w] - d[0] * t) / (theta + total) + free * spell(w)
        return free * (1 - sum(spell(x) for x in customers))

    def score(i, end_tables):
        out = 0.0
        for before, w in zip(["", *texts[i]], texts[i]):
            x = context(before)
            own = (pairs[x, w] - d[1]) if (x, w) in pairs else 0
            out += math.log10((own + (theta + d[1] * tables[x]) * word(w, end_tables)) / (theta + tokens[x]))
        return out

    for i in texts:
        options = [score(i, t) for t in range(1, ends + 1)]
        assert min(options) - 1e-6 <= got[i] <= max(options) + 1e-6
    assert 0 < max(options) - min(options) < 0.6


def test_order_of_words_counts(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    follow = rng.permutation(60)

    def text():
        out = [int(rng.integers(60))]
        for _ in range(80):
            out.append(int(follow[out[-1]]) if rng.random() < 0.8 else int(rng.integers(60)))
        return out

    ids = iter(range(10_000))
    learned = [row(next(i for i in ids if not held_out(i, 7, 2)), " ".join(words[k] for k in text())) for _ in range(60)]
    fresh = [text() for _ in range(10)]
    ordered = [row(next(i for i in ids if held_out(i, 7, 2)), " ".join(words[k] for k in t)) for t in fresh]
    shuffled = [
        row(next(i for i in ids if held_out(i, 7, 2)), " ".join(words[k] for k in rng.permutation(t))) for t in fresh
    ]
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame(learned + ordered + shuffled, SCHEMA)).collect()}
    mean = lambda rows, column: np.mean([got[r[0]][column] / got[r[0]]["n_tokens"] for r in rows])
    assert mean(ordered, "base_score") == pytest.approx(mean(shuffled, "base_score"))
    assert mean(ordered, "score") > mean(shuffled, "score") + 0.5
    # Near what the source itself leaves open: 0.8 * log(0.8) + ..., about 0.7 digits a word.
    assert -0.85 < mean(ordered, "score") < -0.6


def test_chunks_do_not_change_scores(spark, monkeypatch, plain):
    rows = spark.createDataFrame(plain[:60], "doc_id bigint, text string").coalesce(1)
    whole = {r["doc_id"]: r["score"] for r in lm.score(rows).collect()}
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 5_000)
    assert lm.chunks(rows, 4).where("bucket IS NULL").count() > 2
    parts = {r["doc_id"]: r["score"] for r in lm.score(rows).collect()}
    # Words are numbered in another order, so other numbers are drawn.
    assert parts == pytest.approx(whole, rel=0.01)


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(number))]
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split(".")),
                "card": lambda n=number, d=doubled: 13 <= len(n) <= 19 and sum(x // 10 + x % 10 for x in d) % 10 == 0,
                "phone": lambda n=number: 9 <= len(n) <= 15,
            }[kind]()
            if good:
                yield f"{kind}:{m.start()}:{m.end()}"


ODD_TEXTS = [
    "a@b.c@d.e x@y", "@@a@b..c a.b@c-d.e.", "..@..", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256 01.002.3.4",
    "4111111111111111 4111 1111-1111 1112 0", "+1 (212) 555-0100 + 1 +12345678 +1 5.", "1" * 5000, "é+49 30 1234567ß",
]


def test_op4_base_spans(spark, sf, plain):
    got = {r["doc_id"]: r for r in QUERIES["op4_pii"](spark, sf).collect()}
    for doc_id, text in plain:
        want = list(brute_spans(text))
        r = got[doc_id]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        assert set(want) <= set(r["spans"].split(",")) | {""}


def test_strict_patterns_on_odd_texts():
    for text in ODD_TEXTS:
        assert pii.listed([s for s, good in pii.strict(text) if good]).split(",") == (list(brute_spans(text)) or [""])


def test_rewritten_spans_are_found_and_clean_text_is_not(spark):
    model = pii.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    found = {
        "write to john.smith [at] gmail [dot] com please": "john.smith [at] gmail [dot] com",
        "tel (212) 555 1234 ok": "(212) 555 1234",
        "from 10[.]0[.]0[.]1 today": "10[.]0[.]0[.]1",
        "paid by 4111.1111.1111.1111 now": "4111.1111.1111.1111",
    }
    for text, want in found.items():
        assert [text[a:b] for _, a, b in model.spans(text)[1]] == [want]
        assert want not in pii.redact(text, model.spans(text)[1])
    for text in ("on 2024-01-02 we met", "order 1234 5678 9012 3456 of it", 'token = "0641917ea4e9feb9cda"', "at home"):
        assert model.spans(text) == ([], [])


def test_personal_data_of_awkward_rows(awkward, nothing):
    model = pii.learn(awkward)
    got = pii.find(awkward, model).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in awkward.collect())
    (mail,) = [r for r in got if r["doc_id"] == 12]
    assert mail["base"] == ",".join(brute_spans([r["text"] for r in awkward.collect() if r["doc_id"] == 12][0]))
    assert mail["redacted"] == "Mail [email] or [phone], [card] at [ip] 🙂"
    assert pii.find(nothing, pii.learn(nothing)).isEmpty()


def test_unknown_proposals_count_by_their_chance():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 2))
    true = x[:, 0] > 0.6
    right = true & (rng.random(6000) < 0.3)
    known = right | (~true & (rng.random(6000) < 0.1))
    held, group = rng.random(6000) < 0.3, np.zeros(6000, dtype=int)
    y = boosting.chances(x, right, known, held, group, right)
    assert (y[known] == right[known]).all()
    assert y[~known & true].mean() > 0.8 and y[~known & ~true].mean() < 0.05
    no = np.zeros(6000, dtype=bool)
    none = boosting.chances(x, no, known & ~true, held, group, no)
    assert not none.any()
    assert (boosting.chances(x, true, np.ones(6000, dtype=bool), held, group, true) == true).all()


def disguised_rows():
    """Rows, with the planted span of each (None: clean): half of the phone numbers are not in the strict form."""
    rng, out = np.random.default_rng(3), []
    for k in range(1500):
        a, b, c = rng.integers(200, 999), rng.integers(100, 999), rng.integers(1000, 9999)
        kind = k % 3
        if kind == 0:
            span = f"+1 {a} {b} {c}"
        elif kind == 1:
            span = ("{}-{}-{}", "({}) {} {}", "{}.{}.{}")[rng.integers(3)].format(a, b, c)
        else:
            span = f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02}"
        head = "on" if kind == 2 else ("call", "phone", "tel")[rng.integers(3)]
        out.append((row(k, f"{prose(k, 9)} {head} {span} {prose(k + 1, 5)}"), None if kind == 2 else span, kind))
    return out


def test_precision_and_recall_where_disguised_data_is_common(spark):
    planted = disguised_rows()
    model = pii.learn(spark.createDataFrame([p[0] for p in planted], SCHEMA).repartition(3))
    hits = wrong = wanted = 0
    for (_, text, *_), span, kind in planted:
        taken = [text[a:b] for _, a, b in model.spans(text)[1]]
        wanted += kind == 1
        hits += kind == 1 and span in taken
        wrong += sum(t != span for t in taken)
    assert hits >= 0.95 * wanted and wrong <= 0.02 * wanted


def test_personal_data_is_learned_from_all_rows(spark, monkeypatch):
    """5,000 rows with a date and a phone number, and 400 without a doc_id that have an address each."""
    head = [f"on 20{k % 90 + 10}-{k % 12 + 1:02}-{k % 28 + 1:02} call +1 212 555 {k % 9000 + 1000}" for k in range(5_000)]
    rows = [row(k, f"{prose(k, 3)} {text}") for k, text in enumerate(head)]
    rows += [row(None, f"mail me {k} times at jo.{k}@site.example.org") for k in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    seen, fit = [], boosting.fit_total
    monkeypatch.setattr(boosting, "TREES", 4)

    def watched(total, *rest):
        seen.append(total(lambda block: np.array([block.n.sum(), block.n[block.group == 0].sum()])))
        return fit(total, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(boosting, "fit_total", watched)
        model = pii.learn(docs)
    schema = "held boolean, x array<double>, y boolean, made boolean"
    count = docs.select("doc_id", "text").mapInArrow(pii.examples, schema).count()
    assert count > 20_000 and seen and all(s.tolist() == [count, 800] for s in seen)
    monkeypatch.setattr(pii, "DRIVER_ROWS", 0)
    by_tasks = pii.learn(docs.repartition(7))
    assert by_tasks.thresholds == model.thresholds
    for a, b in zip(by_tasks.trees.trees, model.trees.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all()


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    p = boosting.fit(x, y).probability(x)
    assert ((p > 0.5) == y).mean() > 0.97
    at = boosting.threshold(np.array([0.9, 0.8, 0.7, 0.6]), np.array([1, 1, 0, 0]), 0.9)
    assert 0.7 < at < 0.8
    assert boosting.threshold(np.array([0.9]), np.array([0]), 0.9) > 1


# Decontamination


def brute_tiles(text, item, least=5):
    """Greedy string tiling by its definition: the longest common unmarked run, again and again."""
    a, b = decontaminate.words(text), decontaminate.words(item)
    in_a, in_b, covered = [False] * len(a), [False] * len(b), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not (in_a[i + n] or in_b[j + n]):
                    n += 1
                best = max(best, (n, i, j), key=lambda x: x[0])
        n, i, j = best
        if n < least:
            return covered / max(1, len(b))
        for k in range(n):
            in_a[i + k] = in_b[j + k] = True
        covered += n


ITEM = prose(99, 24)
PARTS = ITEM.split()


@pytest.mark.parametrize(
    "text",
    [
        prose(1, 20) + " " + ITEM.upper() + " " + prose(2, 10),
        " ".join([*PARTS[12:], "between", *PARTS[:12]]),
        " ".join([*PARTS[:12], *PARTS[:12], *PARTS[:12]]),
        " ".join([*PARTS[:20], "x", *PARTS[20:]]),
        " ".join(w + "," for w in PARTS),
        prose(5, 40),
        "",
    ],
)
def test_tiles_as_defined(text):
    found = decontaminate.Items([(1, ITEM)], coverage=0.01).tiles(text)
    assert (found[0][1] if found else 0) == pytest.approx(brute_tiles(text, ITEM))


def test_op8_finds_planted_items(spark, sf, plain):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontaminate"](spark, sf).collect()}
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {(i, k) for i, t in plain for k, item in items if item in t}
    assert whole and whole <= got
    rng = np.random.default_rng(0)
    for i, t in [plain[k] for k in rng.choice(len(plain), 12)]:
        if len(t) < 2000:
            for k, item in items[:10]:
                assert ((i, k) in got) == (brute_tiles(t, item) >= decontaminate.COVERAGE)


def test_decontamination_of_awkward_rows(spark, awkward, nothing):
    rows = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "too short"), (None, prose(1, 60)), (5, "no " * 30)]
    benchmark = spark.createDataFrame(rows, "item_id bigint, text string")
    for block in (decontaminate.BLOCK_BYTES, 100):
        got = decontaminate.contaminated(awkward, benchmark, block_bytes=block).collect()
        assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == [(1, None), (2, None), (8, 5)]
        kept = decontaminate.drop_contaminated(awkward, benchmark, block_bytes=block)
        assert kept.schema == awkward.schema and kept.count() == awkward.count() - 3
    assert decontaminate.contaminated(nothing, benchmark).isEmpty()
    assert decontaminate.contaminated(awkward, benchmark.limit(0)).isEmpty()
    assert decontaminate.drop_contaminated(awkward, benchmark.limit(0)).count() == awkward.count()


# Samples


def test_samples_are_bounded_for_each_key_and_do_not_depend_on_order(spark):
    rows = [("hot", k % 5_000, f"t{k}") for k in range(20_000)] + [("rare", None, f"r{k}") for k in range(3)]
    rows += [(f"l{k}", k, "x") for k in range(1_500)] + [(None, 1, "n")]
    table = spark.createDataFrame(rows, "lang string, doc_id bigint, text string")
    got = [
        Counter(tuple(r) for r in hash_sample(t, "lang", 50, "doc_id", "text").collect() if r["lang"] is not None)
        for t in (table.repartition(7), table.coalesce(1).orderBy("text"))
    ]
    assert got[0] == got[1]
    sizes = Counter(r[0] for r in got[0].elements())
    assert sizes["hot"] == 50 and sizes["rare"] == 3 and len(sizes) == 1_502


def test_any_number_of_labels_and_rows_without_doc_ids(spark):
    rows = [row(None, prose(k, 20), f"l{k % 1_500}") for k in range(1_500)]
    learned = next(k for k in range(9) if not held_out(k, 3, 1))
    rows += [row(learned, prose(k, 20), "same") for k in range(30)]
    trees = language.learn(spark.createDataFrame(rows, SCHEMA), sample_rows=10)
    assert len(trees.languages) == 1_501


def test_a_kind_that_is_rare_is_learned(spark):
    rows = [row(k, f"{prose(k, 8)} order {k} {k * 37 % 9973}") for k in range(4_000)]
    rows += [row(10_000 + k, f"{prose(k, 8)} mail jo.{k}@site{k}.example.org now") for k in range(60)]
    model = pii.learn(spark.createDataFrame(rows, SCHEMA).repartition(3), sample_rows=500)
    assert model.thresholds[pii.KINDS.index("email")] <= 1
    _, spans = model.spans("please write to jo.smith [at] site9 [dot] example [dot] org today")
    assert [pii.KINDS[s[0]] for s in spans] == ["email"]

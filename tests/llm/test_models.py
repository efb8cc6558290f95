"""Text-corpus operators that SQL cannot express, against brute force, round trips or accuracy."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cairn.llm import chat, context_mixing, decontamination, simhash, token_counts, toxicity, words
from cairn.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_oracles import messy


def documents(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokens(text):
    return (text or "").encode().lower().split()


# ---- token counts -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_spliced_counts_equal_whole_encoding(tokenizer):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "<|endoftext|>", "é", "1", "!!", "'s", " the", "\x1c", "日本", "\t ", "<|endof",
             "text|>", "a" * 27, "\xa0", "½"]
    short = token_counts._Words(tokenizer, 50, ["<|endoftext|>"])
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 120)))
        want = len(tokenizer.encode(text, add_special_tokens=False))
        assert short.counts([text]) == [want]
        if text:
            assert token_counts.spliced_count(tokenizer, text, rng.randint(20, 60), rng.randint(2, 20), 15) == want


def test_token_count_query(spark, tokenizer):
    docs = documents(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    for df in (docs, messy(spark)):
        want = {r.doc_id: (len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False)))
                for r in df.select("doc_id", "text").collect()}
        for out in (token_counts.count_tokens(df, path), token_counts.count_tokens(df, path, 300, 20, 1024, 100)):
            got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in out.collect()}
            assert got == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in token_counts.count_tokens(docs, path).collect())


def test_token_count_sentencepiece(spark):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = documents(spark).limit(20).cache()
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()}
    assert got == {r.doc_id: len(sp.encode(r.text)) for r in docs.collect()}


# ---- SimHash ------------------------------------------------------------------------------------

def plain_fingerprint(text):
    w = tokens(text)
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, max_bits):
    """Smallest member of each fingerprint's component, by comparing all pairs."""
    u, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= max_bits):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(u))]


def test_simhash_query_against_all_pairs(spark):
    docs = documents(spark).orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in docs]
    want = {docs[i].doc_id: (f"{fps[i]:016x}", docs[g].doc_id) for i, g in enumerate(groups(fps, 3))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, SF_SMALL).collect()}
    assert got == want


def test_simhash_messy_and_repeated_rows(spark):
    docs = messy(spark).unionByName(messy(spark)).unionByName(messy(spark).withColumn("doc_id", F.lit(None).cast("long")))
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    assert {r.component_id for r in out if r.fingerprint == "0" * 16} == {0}
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in out})


@pytest.mark.parametrize("bits,dense,block", [(3, 10_000, 512), (3, 20, 8), (1, 10_000, 512), (5, 30, 16)])
def test_links_connect_the_same_groups(spark, bits, dense, block):
    rng = np.random.default_rng(3)
    fps = [int(x) for x in rng.integers(0, 2**63, 40, dtype=np.uint64)]
    for _ in range(500):
        x = fps[rng.integers(len(fps))]
        for b in rng.choice(64, rng.integers(1, bits + 3), replace=False):
            x ^= 1 << int(b)
        fps.append(x)
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.links(df, bits, dense, block)
    assert all((np.uint64(np.int64(r.a).view(np.uint64)) ^ np.int64(r.b).view(np.uint64)).bit_count() <= bits for r in found.collect())
    root = {r.node: r.root for r in simhash.connected(found).collect()}
    by = collections.defaultdict(list)
    for i, s in enumerate(signed):
        by[root.get(s, s)].append(i)
    assert [min(by[root.get(s, s)]) for s in signed] == groups(fps, bits)


# ---- chat ---------------------------------------------------------------------------------------

def test_chat_round_trip_machine_and_loss(spark):
    rng = random.Random(4)
    bits = ["### ", "</turn>", ": ", "\\", "\n", "x", "<\\/turn>", "##\\# ", "#", "</turn", ">", ":", " ", "é"]
    data = []
    for c in range(60):
        roles = [rng.choice(["system", "user", "assistant", "tool: x", "", None]) for _ in range(rng.randint(1, 6))]
        if c % 2:
            roles = ["user", "assistant"] * 2
        data += [(c, t, r, None if rng.random() < .1 else "".join(rng.choices(bits, k=rng.randint(0, 12)))) for t, r in enumerate(roles)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    t = chat.Template()
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"], t))
    out = {r.conv_id: r for r in chat.format_conversations(df).select("*", loss.alias("loss"), chat.parsed_turns(F.col("formatted")).alias("turns")).collect()}
    for c in range(60):
        want = [(r or "", x or "") for k, _, r, x in data if k == c]
        assert [(x.role, x.text) for x in out[c].turns] == want
        assert out[c].loss == [x for r, x in want if r == "assistant"]
        assert out[c].formatted == "".join(s.text for s in out[c].segments)
        before, bad = None, None
        for i, (r, _) in enumerate(want):
            ok = r in (t.start if before is None else t.follows.get(before, ()))
            bad = i if bad is None and not ok else bad
            before = r
        assert out[c].bad_turn == bad and out[c].valid == (bad is None)


def test_template_rejects_unsafe_control_strings():
    with pytest.raises(ValueError):
        chat.Template(close_mark="##")


# ---- toxicity -----------------------------------------------------------------------------------

def labelled_corpus(spark, n=1500):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(400)]
    data, labels = [], []
    for i in range(n):
        text = rng.choices(vocabulary, k=rng.randint(5, 200))
        toxic = i % 6 == 0
        for _ in range(2 + len(text) // 60 if toxic else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(["grubb", "Snarf", "WOZZLE", "krump"]))
        data.append((i, " ".join(text)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    data += [(n, ""), (n + 1, None), (None, "grubb snarf")]
    labels += [(None, 1, 1), (2, None, None)]
    return spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_unlabelled_and_held_out_texts(spark):
    docs, labels = labelled_corpus(spark)
    out = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(out) == docs.count()
    real = [r for i, r in out.items() if i is not None and i < 1500]
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in real]) > 0.99
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in real)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    assert out[1500].score == out[1501].score and out[1500].predicted == 0 and out[None].predicted == 1


def test_toxicity_never_reads_held_out_labels(spark):
    docs, labels = labelled_corpus(spark)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: round(r.score, 9) for r in toxicity.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_without_toxic_keeps_rows_and_columns(spark):
    docs, labels = labelled_corpus(spark)
    docs = docs.selectExpr("*", "'clash' AS score", "1 AS toxic")
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len([i for i in ids if i is not None and i < 1500 and i % 6 == 0]) <= 2
    assert len([i for i in ids if i is not None and i % 6]) >= 1245


def test_toxicity_counts_all_ordinary_rows_below_the_bound(spark):
    _, labels = labelled_corpus(spark)
    sample = toxicity.labelled(labels, F.lit(True), 500).groupBy("toxic", (F.col("part") > 0).alias("counted")).count().collect()
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").withColumn(
        "counted", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(toxicity.CALIBRATE_EVERY)) > 0)
    have = {(r.toxic, r.counted): r["count"] for r in rows.groupBy("toxic", "counted").count().collect()}
    assert {(r.toxic, r.counted): r["count"] for r in sample} == {k: min(500, n) for k, n in have.items()}
    assert have[0, True] > 500 > have[1, True]


def test_toxic_phrase_of_ordinary_words_in_few_texts(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 7))) for _ in range(300)] + ["red", "door"]
    data, sample = [], []
    for i in range(600):
        text = rng.choices(vocabulary, k=60)
        if i % 3 == 0 and i < 120:             # 40 of the 200 toxic texts
            text[30:30] = ["red", "door"]
        data.append((i, " ".join(text)))
        sample.append((i, int(i % 3 == 0), 1.0, 1))
    model = toxicity.fit_counts(spark.createDataFrame(data, "doc_id long, text string"),
                                spark.createDataFrame(sample, "id long, toxic int, weight double, part int"))
    phrase, turned = toxicity.ratios([b"so red door", b"so door red"], model)
    assert phrase > turned + 0.5


def plain_ratio(train, text):
    """The model's formulas over exact words: (text, toxic) rows, then one text's two most toxic words."""
    d, shared_n, stem, parts = toxicity.DISCOUNT, toxicity.SHARED, toxicity.STEM, toxicity.PARTS
    n = [collections.Counter(), collections.Counter()]
    stems = [collections.Counter(), collections.Counter()]
    for t, y in train:
        w = t.split()
        n[y].update(set(zip(["<s>", *w], w)))
        stems[y].update({(cut, x[:cut]) for x in w for cut in toxicity.PREFIXES})
    mass = [sum(x.values()) for x in n]
    part = [min(mass) / m for m in mass]
    k, e = ([collections.Counter(), collections.Counter()] for _ in range(2))
    used, held = ([collections.Counter(), collections.Counter()] for _ in range(2))
    for c in (0, 1):
        for (v, w), m in n[c].items():
            k[c][w] += 1
            e[c][w] += round((1 - (1 - part[c]) ** m) * parts) / parts
            used[c][v] += m * part[c]
            held[c][v] += max(m - d, 0) * part[c]
    words = set(e[0]) | set(e[1])
    pooled = {w: e[0][w] + e[1][w] for w in words}
    slots = 1 << toxicity.WORD_BITS
    spread = sum(max(x - d, 0) for x in pooled.values()) + d * len(words)
    types = sum(max(1, sum(min(x, 1) for x in y.values())) for y in e)
    shared = lambda w: d * types / 2 * (max(pooled.get(w, 0) - d, 0) + d * len(words) / slots) / spread + shared_n
    left = lambda c, w: max(k[c][w] - d, 0) * e[c][w] / max(k[c][w], 1) / sum(e[c].values()) * sum(e[1].values())
    rest_of_slots = (slots - len(words)) * shared(None)
    whole = [sum(left(c, w) + shared(w) for w in words) + rest_of_slots for c in (0, 1)]
    both = sum(whole) / 2
    base = lambda c, w: left(c, w) / whole[c] + shared(w) / both
    tilt = [sum(base(c, w) / (base(0, w) + base(1, w)) * 2 for w in words) + slots - len(words) for c in (0, 1)]

    def ratio(v, w):
        s = 0.5
        for cut in toxicity.PREFIXES:
            a, b = (stems[c][cut, w[:cut]] * part[c] for c in (0, 1))
            s = (b + stem * s) / (a + b + stem)
        p = [left(c, w) / whole[c] + 2 * x * shared(w) / both for c, x in ((0, 1 - s), (1, s))]
        mean = sum(p) / 2
        rest = sum(used[c][v] - held[c][v] for c in (0, 1)) / 2
        least = min(used[0][v], used[1][v])
        level = [(least + shared_n) / (used[c][v] + shared_n) for c in (0, 1)]
        up = [max(n[c][v, w] - d, 0) * part[c] * level[c] + (shared_n + rest * mean) / mean * p[c] for c in (0, 1)]
        norm = [held[c][v] * level[c] + rest + shared_n * tilt[c] for c in (0, 1)]
        return math.log(up[1] / up[0]) + math.log(norm[0] / norm[1])
    w = text.split()
    top = sorted((ratio(v, x) for v, x in zip(["<s>", *w], w)), reverse=True)[:2]
    return sum(top) / len(top) if top else 0.0


def test_toxicity_where_thousands_of_texts_of_one_class_hold_a_word(spark):
    """The other class's share of such a word is small, not 0: its ratio and all scores are finite and rank held-out rows."""
    names = ["door", "river", "stone", "cloud", "bread", "paper"]
    data = [(i, f"{names[i % 6]} {'scoundrel' if i % 2 else 'neighbour'} {names[i // 6 % 6]}") for i in range(3600)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in data], "doc_id long, quality int, toxic int")
    model = toxicity.fit_counts(docs, labels.selectExpr("doc_id AS id", "toxic", "1D AS weight", "1 AS part"))
    assert np.isfinite(toxicity.ratios([t.encode() for _, t in data[:12]], model)).all()
    held = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    assert min(r.score for r in held if r.doc_id % 2) > 0.7 > max(r.score for r in held if r.doc_id % 2 == 0)


def test_toxicity_model_against_plain_formulas(spark):
    rng = random.Random(18)
    stems = ["scoun", "blight", "murk", "vile", "house", "river", "garden", "letter", "quiet"]
    word = lambda toxic: rng.choice(stems[:4] if toxic and rng.random() < 0.2 else stems[4:]) + rng.choice(["", "er", "ing", "ful", "ness", "ish"])
    train = [(" ".join(word(i % 4 == 0) for _ in range(rng.randint(3, 30))), int(i % 4 == 0)) for i in range(160)]
    model = toxicity.fit_counts(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(train)], "doc_id long, text string"),
                                spark.createDataFrame([(i, y, 1.0, 1) for i, (_, y) in enumerate(train)], "id long, toxic int, weight double, part int"))
    texts = [t for t, _ in train[:10]] + ["scounable riverside", "unknown words only", "blighted", "house vileful garden", ""]
    got = toxicity.ratios([t.encode() for t in texts], model)
    for t, r in zip(texts, got):
        assert abs(r - plain_ratio(train, t)) < 2e-3, t
    form, none = toxicity.ratios([b"scounless", b"zzyzx"], model)          # a form never seen, and a word like no other
    assert form > 0.5 > abs(none)


# ---- decontamination ----------------------------------------------------------------------------

def test_lcs_length():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([bytes([97 + rng.randint(0, 4)]) for _ in range(rng.randint(0, 12))] for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        assert decontamination.lcs_length(a, b) == d[-1][-1]


def test_leaks_found_and_clean_documents_left(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    say = lambda n: rng.choices(vocabulary, k=n)
    items = [say(rng.randint(15, 60)) for _ in range(40)] + [say(200)]
    data, want = [], set()
    for d in range(400):
        text = say(rng.randint(20, 600))
        kind, i = d % 8, rng.randrange(len(items))
        if kind in (0, 1):                     # word for word, other case and punctuation
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in items[i]]
            want.add((d, i))
        elif kind == 2:                        # paraphrase: every sixth word replaced
            at = rng.randint(0, len(text))
            text[at:at] = [say(1)[0] if k % 6 == 3 and k < len(items[i]) - 5 else w for k, w in enumerate(items[i])]
            want.add((d, i))
        data.append((d, " ".join(text), "clash"))
    data += [(900, None, ""), (901, "", ""), (902, "one", "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, score string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    out = decontamination.leaks(docs, bench)
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert len(want - got) <= 0.02 * len(want) and got <= want
    kept = decontamination.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in data} - {d for d, _ in got}


def test_short_item_in_a_third_of_the_documents(spark):
    rng = random.Random(13)
    item = [f"hot{k}" for k in range(9)]
    data, want = [], set()
    for d in range(900):
        text = [f"rare{rng.randrange(10**6)}" for _ in range(150)]
        if d % 3 == 0:
            text[60:60] = [f"other{d}" if k in (2, 5) and d % 2 else w for k, w in enumerate(item)]
            want.add(d)
        data.append((d, " ".join(text)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    out = decontamination.leaks(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {r.doc_id for r in out.collect()} == want


def plain_leaks(docs, items):
    """The rule read off the page: every document, passage and place, with exact words."""
    words = {d: (t or "").lower().split() for d, t in docs}
    n = len(words)
    df = collections.Counter(w for t in words.values() for w in set(t))
    cf = collections.Counter(w for t in words.values() for w in t)
    total = sum(cf.values())
    idf = lambda w: max(math.log((n + 1) / df.get(w, 1)), 0.25)
    nats = lambda w: math.log(total / cf.get(w, 1))
    ways = lambda n, k: math.log(math.comb(n, k))
    bound = math.log(total) + math.log(sum(len(t.encode()) / 32 + 1 for _, t in items)) - math.log(0.01)
    out = set()
    for item, text in items:
        t = text.split()
        last = max(0, len(t) - 32)
        for lo in {*range(0, last, 32), last}:
            p = t[lo:lo + 32]
            for d, w in words.items():
                for start in range(0, len(w), len(p)):
                    near = w[start:start + 2 * len(p)]
                    here = [x for x in p if x in set(near)]
                    k = decontamination.lcs_length([x.encode() for x in p], [x.encode() for x in near])
                    if k < 0.6 * len(p):
                        continue
                    light = sorted(map(idf, here))[:k]
                    whole = k == len(p) and any(near[i:i + k] == p for i in range(len(near)))
                    sure = sum(sorted(map(nats, here))[:k]) - (0 if whole else ways(len(near), k) + ways(len(p), k))
                    if sure >= bound and (k == len(p) or sum(light) >= 0.4 * sum(map(idf, p))):
                        out.add((d, item))
    return out


@pytest.mark.parametrize("zipf", [False, True])
def test_leaks_against_brute_force_over_all_places(spark, zipf):
    rng = random.Random(14 + zipf)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)] if zipf else None
    say = lambda n: rng.choices(vocabulary, weights, k=n)
    items = [say(n) for n in [*range(1, 15), *(rng.randint(15, 70) for _ in range(12))]]
    data = []
    for d in range(130):
        text, item = say(rng.randint(0, 150)), list(items[d % len(items)])
        for k in rng.sample(range(len(item)), int(len(item) * rng.choice([0, .1, .22, .3, .38, .6]))):
            item[k] = "x" + rng.choice(vocabulary)
        at = rng.randint(0, len(text))
        text[at:at] = item
        data.append((d, " ".join(text)))
    bench = [(i, " ".join(t)) for i, t in enumerate(items)]
    want = plain_leaks(data, bench)
    assert len(want) > 30
    out = decontamination.leaks(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} == want


def test_independent_items_of_any_length_match_nothing(spark):
    rng = np.random.default_rng(15)
    p = 1 / np.arange(1, 20_001)
    say = lambda n: " ".join(f"w{k}" for k in rng.choice(20_000, n, p=p / p.sum()))
    docs = spark.createDataFrame([(d, say(400)) for d in range(1000)], "doc_id long, text string")
    items = spark.createDataFrame([(100 * n + i, say(n)) for n in range(1, 21) for i in range(6)], "item_id long, text string")
    assert decontamination.leaks(docs, items).count() == 0
    assert decontamination.without_leaks(docs, items).count() == 1000


def test_short_planted_items_are_found(spark):
    rng = np.random.default_rng(16)
    p = 1 / np.arange(1, 5001)
    say = lambda n: [f"w{k}" for k in rng.choice(5000, n, p=p / p.sum())]
    items = [[f"rare{n}x{k}" if k % 2 else say(1)[0] for k in range(n)] for n in range(1, 15)]
    data, want = [], set()
    for d in range(700):
        text = say(300 if d else 200_000)                  # one very long document
        if d % 10 == 0:
            text[150:150] = items[d // 10 % 14]
            want.add((d, d // 10 % 14))
        data.append((d, " ".join(text)))
    out = decontamination.leaks(spark.createDataFrame(data, "doc_id long, text string"),
                                spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert got <= want
    assert {(d, i) for d, i in want if i >= 7} <= got      # eight words, four of them rare, and more
    assert not any(i == 0 for _, i in got)                 # a word proves nothing


def test_benchmark_of_several_groups(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "GROUP_BLOCKS", 2)
    rng = random.Random(17)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(4000)]
    items = [rng.choices(vocabulary, k=20) for _ in range(1500)]
    data = [(d, " ".join(rng.choices(vocabulary, k=50) + (items[d * 4] if d % 2 else []) + rng.choices(vocabulary, k=50))) for d in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = {(d, d * 4) for d in range(300) if d % 2}
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()} == want
    assert {r.doc_id for r in decontamination.without_leaks(docs, bench).collect()} == {d for d in range(300) if d % 2 == 0}


def test_randomised_svd_keeps_inner_products(spark):
    rng = np.random.default_rng(8)
    passages = []
    for p in range(60):
        slots = np.unique(rng.integers(0, 500, 40))
        v = rng.random(len(slots)).astype(np.float32)
        passages.append({"slots": slots, "vector": v / np.linalg.norm(v)})
    slots, basis, at = decontamination._latent(spark, passages, 64)
    a = np.zeros((60, 500))
    for i, p in enumerate(passages):
        a[i, p["slots"]] = p["vector"]
    assert np.allclose(at @ at.T, a @ a.T, atol=1e-3)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-3)


# ---- language model -----------------------------------------------------------------------------

def test_language_model_base_columns(spark):
    docs = documents(spark).unionByName(spark.createDataFrame([(9000, None), (9001, ""), (None, "zz zz Zz")], "doc_id long, text string"), True)
    everything = docs.select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = collections.Counter(w for r in everything if not held(r.doc_id) for w in [*tokens(r.text), b""])
    n, v = sum(c.values()), len(c)
    out = {r.doc_id: r for r in context_mixing.score(docs).collect()}
    assert len(out) == len(everything)
    for r in everything:
        w, o = [*tokens(r.text), b""], out[r.doc_id]
        base = sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in w)
        assert (o.held_out, o.n_tokens, o.n_known, o.train_tokens) == (held(r.doc_id), len(w), sum(c[x] > 0 for x in w), n)
        assert abs(o.base_score - base) < 1e-6 * abs(base) and -math.inf < o.score < 0


def test_bit_model_is_a_distribution_and_learns():
    some = [b"anna", b"anton", b"an", b"ton", b"tonna", b""]
    counts = np.zeros((2, sum(1 << b for b in context_mixing.TABLE_BITS)), np.float32)
    grid, length, owner = context_mixing._pieces(some)
    for live, _, slots, one in context_mixing._steps(grid, length):
        for side in (0, 1):
            np.add.at(counts[side], slots[one == side].ravel(), 20)
    mixer = context_mixing.new_mixer()
    first = np.array([bytes([b]) for b in range(256) if b not in b" \t\n\x0b\x0c\r"])
    whole = context_mixing.word_bits([w + b"" for w in first.tolist()] + [b""], counts, mixer)
    assert np.exp2(-whole).sum() < 1
    known, strange = context_mixing.word_bits(some, counts, mixer), context_mixing.word_bits([b"qxjz", b"zzqzz"], counts, mixer)
    assert known.max() < strange.min()
    before = known.sum()
    for _ in range(20):
        context_mixing.learn(some * 50, np.full(300, 20), counts, mixer)
    assert context_mixing.word_bits(some, counts, mixer).sum() < before
    assert np.isfinite(context_mixing.word_bits([b"x" * 5000], counts, mixer)).all()


def test_document_adaptation_equals_word_by_word():
    rng = random.Random(9)
    p = [.5, .3, 1e-9]
    texts = [[rng.choice([0, 0, 0, 1, 1, 2]) for _ in range(n)] for n in (60, 1, 7)]
    want = []
    for text in texts:
        seen, bits = collections.Counter(), 0.0
        for i, w in enumerate(text):
            bits -= math.log2((context_mixing.MEMORY * p[w] + seen[w]) / (context_mixing.MEMORY + i))
            seen[w] += 1
        want.append(bits)
    flat = np.concatenate(texts)
    got = context_mixing.adapted_bits(np.array([60, 1, 7]), flat, np.log(np.array(p)[flat]))
    assert np.allclose(got, want, atol=1e-6)


def _texts(lines: list[str]) -> context_mixing.Texts:
    words = [b"", *sorted({w.encode() for t in lines for w in t.split()})]
    tokens = [[words.index(w.encode()) for w in t.split()] + [0] for t in lines]
    return context_mixing.Texts(0, list(range(len(lines))), np.array([len(t) for t in lines]),
                                np.array([len(t) for t in tokens]), words, np.concatenate(tokens).astype(np.int32))


def _word_model(lines: list[str], top: int):
    """Code, counts and a mixer whose weights are not the starting ones."""
    t = _texts(lines)
    c = np.bincount(t.tokens, minlength=len(t.words))
    best = sorted(range(len(c)), key=lambda i: (-c[i], t.words[i]))[:top]
    code = context_mixing.prefix_code([t.words[i] for i in best], c[best].tolist(), int(c.sum() - c[best].sum()), (12, 12, 11))
    counts = np.zeros((2, int(code.starts[-1])), np.float32)
    context_mixing.count_words(code, context_mixing.in_line(code, t), counts)
    mixer = context_mixing.new_word_mixer()
    context_mixing.learn_words(code, context_mixing.in_line(code, t), counts, mixer, group=64)
    return t, code, counts, mixer


LINES = [" ".join(random.Random(i).choices("the a cat dog sat ran on of mat rug xylophone".split(), [9, 8, 4, 4, 3, 3, 3, 3, 2, 2, 1], k=i % 17))
         for i in range(200)]


def test_words_are_scored_as_by_a_plain_loop_over_bits(monkeypatch):
    """Every token's bits against scalar arithmetic, one decision after another, the contexts and hashes spelled out."""
    monkeypatch.setattr(context_mixing, "COMMON", 3)
    t, code, counts, mixer = _word_model(LINES, 8)
    got = context_mixing.path_bits(code, context_mixing.in_line(code, t), context_mixing.looked_up(counts), mixer)
    full, at, levels = (1 << 64) - 1, 0, [.5, 1.5, 7.5, 63.5]
    for n in t.lengths.tolist():
        before, common = [0, 0], 0                                       # the words two back and one back
        for k in t.tokens[at:at + n].tolist():
            two, one = before
            odd, spread = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
            contexts = [one * odd & full, ((one * spread + two) * odd + 1) & full, (common * odd + 2) & full]
            leaf = code.leaf.get(t.words[k], len(code.first) - 1)
            bits = 0.0
            for depth in range(code.size[leaf]):
                step = code.first[leaf] + depth
                node, bit = int(code.node[step]), int(code.bit[step])
                slots, start = [node], len(code.first) - 1
                for context, b in zip(contexts, code.bits):
                    h = (context ^ ((node + 1) * spread & full)) * odd & full
                    slots.append((((h ^ (h >> 31)) * odd & full) >> (64 - b)) + start)
                    start += 1 << b
                inputs = [math.log((counts[1][s] + .1) / (counts[0][s] + .1)) for s in slots] + [1.0]
                level = [sum(counts[0][s] + counts[1][s] > x for x in levels) for s in slots]
                gate = (level[2] * 5 + level[1]) * 4 + min(depth // 3, 3)
                dot = min(max(sum(w * x for w, x in zip(mixer["weights"][gate], inputs)), -8), 8)
                x = (dot + 8) * 2
                low = min(int(x), 31)
                table = mixer["refine"][min(depth, 7)]
                refined = table[low] * (1 - x + low) + table[low + 1] * (x - low)
                p = min(max((1 / (1 + math.exp(-dot)) + refined) / 2, 1e-6), 1 - 1e-6)
                bits -= math.log2(p if bit else 1 - p)
            assert abs(bits - got[at]) < 1e-3 * max(1, bits)
            before = [one, zlib.crc32(t.words[k]) + 1]
            common = before[1] if code.leaf.get(t.words[k], 99) < 3 and t.words[k] else common
            at += 1


def test_paths_are_a_distribution_given_the_words_before():
    t, code, counts, mixer = _word_model(LINES, 8)
    for context in ("the cat", "", "xylophone of"):
        ends = [w.decode() for w in code.leaf if w] + ["unheard"]
        total = 0.0
        for w in [*ends, None]:
            one = _texts([f"{context} {w}" if w else context])
            bits = context_mixing.path_bits(code, context_mixing.in_line(code, one), context_mixing.looked_up(counts), mixer)
            total += 2 ** -bits[len(context.split())]
        assert abs(total - 1) < 1e-4


def test_word_contexts_are_counted_as_by_a_plain_loop(monkeypatch):
    """Contexts that are few are counted by leaf and those of words before decision by decision: both are the plain counts."""
    monkeypatch.setattr(context_mixing, "COMMON", 3)
    t, code, counts, _ = _word_model(LINES, 8)
    want, full, at = np.zeros_like(counts), (1 << 64) - 1, 0
    odd, spread = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
    for n in t.lengths.tolist():
        one = two = common = 0
        for k in t.tokens[at:at + n].tolist():
            leaf, start = code.leaf.get(t.words[k], len(code.first) - 1), len(code.first) - 1
            contexts = [one * odd & full, ((one * spread + two) * odd + 1) & full, (common * odd + 2) & full]
            for step in range(code.first[leaf], code.first[leaf] + code.size[leaf]):
                node, bit, begin = int(code.node[step]), int(code.bit[step]), start
                want[bit, node] += 1
                for context, b in zip(contexts, code.bits):
                    h = (context ^ ((node + 1) * spread & full)) * odd & full
                    want[bit, (((h ^ (h >> 31)) * odd & full) >> (64 - b)) + begin] += 1
                    begin += 1 << b
            two, one = one, zlib.crc32(t.words[k]) + 1
            common = one if leaf < 3 and t.words[k] else common
        at += n
    assert (counts == want).all()
    line = context_mixing.in_line(code, t)
    few = np.zeros_like(counts)
    context_mixing.count_near(code, line, few)                           # as they are many, only these go one by one
    assert few.sum() == counts.sum() / 2 == 2 * code.size[line.leaf].sum()


def test_weights_are_learned_as_by_a_plain_loop():
    """A group's pull at each weight and place of the refinement, decision by decision."""
    t, code, counts, mixer = _word_model(LINES, 8)
    line, group = context_mixing.in_line(code, t), 64
    got = {k: v.copy() for k, v in mixer.items()}
    context_mixing.learn_line(code, line, context_mixing.lookup(code, context_mixing.left_out(counts)), got, group)
    stretch, level = context_mixing.left_out(counts)
    start, nodes = code.starts, int(code.starts[1])
    common = context_mixing.common_slots(code)
    for lo in range(0, len(line.leaf), group):
        hi = min(lo + group, len(line.leaf))
        pulls, mass = np.zeros((100, 5)), np.zeros(100)
        lower, upper = np.zeros((2, 8, 33)), np.zeros((2, 8, 33))
        at, way, node, slots = context_mixing.decisions(code, line, lo, hi)
        depth = 0
        for i in range(len(at)):
            depth = depth + 1 if i and at[i] == at[i - 1] else 0
            bit = int(way[i]) & 1
            where = [int(node[i]), int(slots[0][i] + start[1]), int(slots[1][i] + start[2]), int(common[line.last[lo + at[i]], node[i]] + start[3])]
            x = np.array([*(stretch[2 * s + bit] for s in where), 1.0])
            gate = (int(level[2 * where[2] + bit]) * 5 + int(level[2 * where[1] + bit])) * 4 + min(depth // 3, 3)
            dot = min(max(float(mixer["weights"][gate] @ x), -8), 8)
            pulls[gate] += (bit - 1 / (1 + math.exp(-dot))) * np.clip(x, -4, 4)
            mass[gate] += 1
            low = min(int((dot + 8) * 2), 31)
            for share, y in ((lower, 1 - (dot + 8) * 2 + low), (upper, (dot + 8) * 2 - low)):
                share[bit, min(depth, 7), low] += y
        mixer["weights"] += context_mixing.LEARN_WORDS * pulls / np.maximum(mass, 32)[:, None]
        for share in (lower, np.roll(upper, 1, 2)):
            pull = share.sum(0)
            goal = share[1] / np.maximum(pull, 1e-9)
            mixer["refine"] += context_mixing.REFINE * np.where(pull > 0, goal - mixer["refine"], 0) * np.minimum(pull, 1)
    assert nodes == len(code.first) - 1
    assert np.allclose(got["weights"], mixer["weights"], atol=1e-4) and np.allclose(got["refine"], mixer["refine"], atol=1e-4)


def test_words_that_begin_alike_are_spelled_as_one():
    rng = random.Random(2)
    some = ["".join(rng.choices("abc", k=rng.randint(0, 9))).encode() for _ in range(500)] + [b"x" * 95, b"ab"]
    c = np.array([rng.randint(1, 9) for _ in some])
    grid, length, owner = context_mixing._pieces(some)
    plain, merged = (np.zeros((2, sum(1 << b for b in context_mixing.TABLE_BITS)), np.int64) for _ in range(2))
    rows = [0, 0]
    for live, _, slots, one in context_mixing._steps(grid, length):
        np.add.at(plain, (one[:, None], slots), c[owner][:live, None])
        rows[0] += live
    for often, _, slots, one in context_mixing._steps(grid, length, c[owner]):
        np.add.at(merged, (one[:, None], slots), often[:, None])
        rows[1] += len(often)
    assert (plain == merged).all() and rows[1] < .7 * rows[0]


def test_texts_are_numbered_as_by_splitting_them():
    rng = random.Random(3)
    for _ in range(300):
        texts = [None if rng.random() < .1 else bytes(rng.choices(b"aBZ \t\n\x0b\x0c\r\xc3\xa9\x00\x1c\x85\xa0", k=rng.choice([0, 1, 2, 5, 30])))
                 for _ in range(rng.randint(1, 6))]
        number, want = {b"": 0}, []
        for text in texts:
            want.append([number.setdefault(w, len(number)) for w in [*(text or b"").lower().split(), b""]])
        distinct, got, sizes = context_mixing.numbered(texts)
        assert distinct == b" ".join(number) and got.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


def test_one_word_code_and_no_words():
    code = context_mixing.prefix_code([], [], 0, (12, 12, 12))
    line = context_mixing.in_line(code, _texts(["a b", ""]))
    counts = np.zeros((2, int(code.starts[-1])), np.float32)
    assert not context_mixing.path_bits(code, line, context_mixing.looked_up(counts), context_mixing.new_word_mixer()).any()
    context_mixing.learn_words(code, line, counts, context_mixing.new_word_mixer())


def test_every_training_text_and_word_teaches_the_weights(spark):
    """Texts and words one by one: each moves its task's weights, whatever its checksum."""
    line, broadcast = "the cat sat on the mat the cat ran", spark.sparkContext.broadcast
    sums = {i: zlib.crc32(str(i).encode()) for i in range(60)}
    teaches = [i for i, x in sums.items() if x % 10 and x // 10 % 10]
    t, code, counts, _ = _word_model([line] * 3, 4)
    given, left = broadcast(tuple(code)), broadcast(context_mixing.left_out(counts))
    start = context_mixing.new_word_mixer()["weights"]
    for i in (teaches[:3], [j for j, x in sums.items() if x % 10 == 0]):
        texts = context_mixing.encoded(spark.createDataFrame([(j, line) for j in i], "doc_id long, text string"))
        assert (context_mixing.fit_words(texts, given, left)["weights"] != start).any() == (i[0] in teaches)
    slots = sum(1 << b for b in context_mixing.TABLE_BITS)
    words = [w for w in (f"w{i}".encode() for i in range(40)) if zlib.crc32(w) // 10 % 10][:3]      # not one of ten by checksum
    rows = spark.createDataFrame([(bytearray(w), 2) for w in words], "word binary, c long")
    got = context_mixing.fit_spelling(rows, broadcast(context_mixing.left_out(np.ones((2, slots), np.float32))))
    assert (got["weights"] != context_mixing.new_mixer()["weights"]).any()


def test_left_out_tables_are_the_counts_less_the_decision():
    counts = np.array([[0, 1, 5, 70], [2, 0, 3, 1]], np.float32)
    stretch, level = context_mixing.left_out(counts)
    for slot in range(4):
        for bit in (0, 1):
            zero, one = max(counts[0, slot] - (1 - bit), 0), max(counts[1, slot] - bit, 0)
            assert abs(stretch[2 * slot + bit] - math.log((one + .1) / (zero + .1))) < 1e-5
            assert level[2 * slot + bit] == sum(zero + one > x for x in (.5, 1.5, 7.5, 63.5))


def test_score_depends_on_the_order_of_words_and_beats_the_base(spark):
    rng = random.Random(4)
    chains = [[f"w{i}x{j}" for j in range(6)] for i in range(12)]
    texts = [" ".join(w for _ in range(8) for w in rng.choice(chains)) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)]
    mixed = [(10_000 + i, " ".join(rng.sample(t.split(), 48))) for i, t in rows[:200]]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    rows += [(i, t) for i, t in mixed if held(i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS batch", "1 AS word", "'y' AS bits", "2 AS c")
    out = context_mixing.score(docs).toPandas()
    out = out[out.held_out]
    usual, shuffled = out[out.doc_id < 10_000], out[out.doc_id >= 10_000]
    assert len(usual) and len(shuffled)
    assert usual.score.mean() > usual.base_score.mean() / 2              # the next word of a chain is known
    assert usual.score.min() > shuffled.score.max()
    assert abs(usual.base_score.mean() - shuffled.base_score.mean()) < 5


def test_counts_above_float_precision(spark):
    big = (1 << 24) + 1
    rows = spark.createDataFrame([(b"aa", 1 << 24), (b"aa", 1), (b"ab", 3)], "word binary, c long")
    counts = context_mixing.context_counts(rows, 130)                     # more tables than are added at a time
    grid, length, _ = context_mixing._pieces([b"aa"])
    _, _, slots, one = next(context_mixing._steps(grid, length))
    assert counts[one[0], slots[0, 0]] == np.float32(big + 3)


def test_language_model_prefers_text_of_its_kind(spark):
    docs = documents(spark)
    odd = spark.createDataFrame([(50_000 + i, " ".join(random.Random(i).choices(["qzxk", "wvvq", "jjxz", "kqkq"], k=40)), ) for i in range(20)], "doc_id long, text string")
    # ids whose checksum holds them out of the training part
    odd = odd.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    out = context_mixing.score(docs.select("doc_id", "text").unionByName(odd)).toPandas()
    held = out[out.held_out]
    usual, strange = held[held.doc_id < 50_000], held[held.doc_id >= 50_000]
    assert len(strange) and usual.bits_per_byte.mean() < strange.bits_per_byte.min() + 1


# ---- word hashing -------------------------------------------------------------------------------

def test_hashed_words_follow_words(monkeypatch):
    rng = random.Random(10)
    texts = [None, b"", b"  "] + [bytes(rng.choices(b"aB \t\n\x0b\xc3\xa9", k=rng.randint(0, 300))) for _ in range(60)]
    want = [(t or b"").lower().split() for t in texts]
    for step in (1 << 20, 16):
        monkeypatch.setattr(words, "STEP_BYTES", step)
        h, at = words.hashed_words(texts)
        known = {}
        for i, w in enumerate(want):
            assert at[i + 1] - at[i] == len(w)
            for x, y in zip(w, h[at[i]:at[i + 1]].tolist()):
                assert known.setdefault(x, y) == y
        assert len(set(known.values())) == len(known)

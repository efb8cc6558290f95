"""Prefix trie, packing and fill-in-the-middle against brute force, on messy and on whole small tables."""

import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairn.llm import fill_middle, packing, prefix_trie
from cairn.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_oracles import messy

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPACE = r"\x20\x09-\x0D"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


def hostile(spark):
    """Messy documents, repeated rows, null ids, sentinels and special tokens in texts, odd characters, a huge word."""
    data = [(500 + i, t) for i, t in enumerate([
        "<P> in a text", "a <|endoftext|> b", "日本語 text ½ \x85x", "w" * 700_000, " " * 5000, "é" * 300_000 + " x", "\x1c a b",
        "<", "P>", "a <\nM", "one", " one ", "word " * 60_000])]
    data += [(None, "null id"), (None, "null id"), (None, None), (7, "again"), (7, "again"), (-3, "negative id here")]
    own = spark.createDataFrame(data, "doc_id long, text string")
    return messy(spark).unionByName(own, allowMissingColumns=True)


# ---- prefix trie --------------------------------------------------------------------------------

def plain_trie(rows, block=20, heads=4):
    """Nodes by walking every rebuilt conversation."""
    own = collections.defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            own[r.conv_id].append((r.turn is not None, r.turn or 0, (r.role or "").encode(), (r.text or "").encode()))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % block if c >= 0 else -(abs(c) % block))
        paths[c] = own.get(base, [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    kids = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, m in members.items():
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(m) - 1) * words
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(n)))).encode()).hexdigest())
                   for n, m in members.items()), key=str)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def told(df):
    return sorted((tuple(r) for r in df.select(*NODE).collect()), key=str)


def conversations(spark, seed, n=90, turns=5):
    """Few distinct turns, so heads coincide; nulls everywhere, repeated rows, negative and absent bases."""
    rng = random.Random(seed)
    data = []
    for c in range(n):
        conv = rng.choice([None, c, c, c, -c, 20 * c + 7, 40 + c % 20])
        for t in range(rng.choice([0, 1, 2, 3, turns, 2 * turns])):
            data.append((conv, rng.choice([None, t, t, t, 1]), rng.choice(["user", "user", None, ""]), rng.choice(["a b", "a  b\n", None, "", "É x y"]),
                         "clash", 1))
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, depth string, k1 int").repartition(5)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_messy_against_walk(spark, seed):
    rows = conversations(spark, seed).cache()
    assert told(prefix_trie.trie(rows)) == plain_trie(rows.collect())
    assert told(prefix_trie.trie(rows, 7, 3)) == plain_trie(rows.collect(), 7, 3)


def test_trie_query_against_walk(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    assert told(QUERIES["op11_prefix_trie"](spark, SF_SMALL)) == plain_trie(rows)


def test_trie_colliding_fingerprints_are_found_out(spark):
    rows = conversations(spark, 4).cache()
    want = plain_trie(rows.collect())
    weak = prefix_trie._grouped(prefix_trie.prefixes(prefix_trie.stored_turns(rows, 20, 4, 0), 4, 0, 13))
    assert not weak.filter("NOT same").isEmpty()
    assert told(prefix_trie.trie(rows, primes=(13, 31, prefix_trie.PRIME))) == want


def test_trie_hot_turn_and_many_children(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HOT_CHILDREN", 8)
    data = [(20 * c, 0, "user", "same first turn" if c % 3 else f"own turn {c}") for c in range(400)]
    data += [(20 * c, 1, "assistant", f"answer {c % 50}") for c in range(400)]
    rows = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(prefix_trie, "END_RANGE_BITS", 6)
    assert told(prefix_trie.trie(rows)) == plain_trie(rows.collect())


def test_monoid_is_associative_and_refers_to_stored_turns(spark):
    p, rng = prefix_trie.PRIME, random.Random(1)
    for _ in range(50):
        a, b, c = ((rng.randrange(p), rng.randrange(p)) for _ in range(3))
        assert prefix_trie.times(prefix_trie.times(a, b, p), c, p) == prefix_trie.times(a, prefix_trie.times(b, c, p), p)
    rows = conversations(spark, 5).cache()
    turns, paths, groups = prefix_trie.proven(rows)
    depths = groups.filter("depth > 0")
    assert depths.join(turns.select("turn_id", "words"), ["turn_id", "words"]).count() == depths.count()
    assert paths.count() == groups.agg(F.sum("n_convs")).first()[0]


def test_trie_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(none).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], none.schema)).count() == 0


# ---- packing ------------------------------------------------------------------------------------

def check_places(rows, limit):
    """Sequences are filled gapless from 0 and never beyond the limit; returns their number."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at and n > 0
            at += n
        assert at <= limit
    return len(by)


@pytest.mark.parametrize("limit", [2048, 64])
def test_pieces_equal_the_library(spark, tokenizer, limit):
    docs = hostile(spark).select("doc_id", "text").repartition(3)
    got = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packing.pieces(docs, BPE, limit).collect())
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % limit or limit
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, limit)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert got == want


def test_fast_encoder_equals_the_library(tokenizer):
    encode, rng = packing.encoder(open(BPE, "rb").read()), random.Random(2)
    vocab = list(json.load(open(BPE))["model"]["vocab"])
    parts = [tokenizer.decode([i]) for i in rng.sample(range(len(vocab) - 1), 4000)] + [chr(c) for c in range(0x250)] + ["  ", "\n", "'s"]
    for _ in range(8000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_use_the_library(tokenizer):
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, tok = packing.encoder(open(path, "rb").read()), Tokenizer.from_file(path)
    for text in ("Some words here, and 12 more!", "<|endoftext|>x"):
        assert encode(text).tolist() == tok.encode(text, add_special_tokens=False).ids


def brute_best_fit(lengths, limit, open_bins):
    """The same rule over a plain list of open sequences."""
    bins, n, out = [], 0, []
    for size in lengths:
        fits = [b for b in bins if b[0] >= size]
        best = max(i for i, b in enumerate(fits) if b[0] == min(x[0] for x in fits)) if fits else None
        if best is None:
            b, n = [limit, n, 0], n + 1
        else:
            b = fits[best]
            bins.remove(b)
        out.append((b[1], limit - b[0]))
        if b[0] > size:
            bins.append([b[0] - size, b[1], 0])
        if len(bins) > open_bins:
            full = min(x[0] for x in bins)
            bins.remove([b for b in bins if b[0] == full][-1])
    return out


@pytest.mark.parametrize("open_bins", [1, 3, 40])
def test_best_fit_rule(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.choice([rng.randint(1, 64), 64, 1, 33]) for _ in range(1500)]
    bins = packing.BestFit(64, open_bins)
    assert [bins.place(n) for n in lengths] == brute_best_fit(lengths, 64, open_bins)


def test_packing_query_is_tight(spark):
    rows = QUERIES["op12_best_fit_packing"](spark, SF_SMALL).collect()
    used = check_places(rows, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 2
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op12_best_fit_packing"](spark, SF_SMALL).collect()))


def test_packing_messy_many_tasks_and_few_bins(spark, monkeypatch):
    docs = hostile(spark).select("doc_id", "text").repartition(3)
    for window, bins in ((32_768, 16_384), (50, 4)):
        monkeypatch.setattr(packing, "WINDOW", window)
        rows = packing.pack(docs, BPE, 256, bins).collect()
        check_places(rows, 256)
        assert len(rows) == packing.pieces(docs, BPE, 256).count()


def test_packing_tasks_follow_the_pieces():
    assert packing._tasks(0, 8) == (1, 1) and packing._tasks(100_000, 8) == (4, 1)
    assert packing._tasks(1 << 20, 8) == (8, 4) and packing._tasks(10 << 20, 8) == (10, 32)


def test_sequences_hold_the_documents(spark, tokenizer):
    docs = hostile(spark).select("doc_id", "text").filter("doc_id IS NOT NULL AND doc_id <> 7")
    seqs = packing.sequences(docs, BPE, 512).collect()
    parts = {}
    for s in seqs:
        assert len(s.ids) <= 512 and sum(x.length for x in s.spans) == len(s.ids)
        for x in s.spans:
            parts[x.doc_id, x.piece] = s.ids[x.offset:x.offset + x.length]
    for r in docs.collect():
        ids = [i for k in sorted(k for k in parts if k[0] == r.doc_id) for i in parts[k]]
        assert ids == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]


def test_packing_empty(spark):
    none = messy(spark).limit(0)
    assert packing.pack(none, BPE).count() == 0 and packing.sequences(none, BPE).count() == 0


# ---- fill in the middle -------------------------------------------------------------------------

def plain_fill(doc_id, text, seed=42, fim=50, spm=80):
    text = text or ""
    u = re.findall(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+", text)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return len(u), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("units,size,fim,spm", [(4096, 1 << 16, 50, 80), (2, 40, 100, 50), (1, 1 << 16, 100, 0)])
def test_fill_in_middle_messy(spark, monkeypatch, units, size, fim, spm):
    monkeypatch.setattr(fill_middle, "CHUNK_UNITS", units)
    monkeypatch.setattr(fill_middle, "CHUNK_BYTES", size)
    docs = hostile(spark)
    docs = docs.filter("coalesce(length(text), 0) < 20000") if units < 4096 else docs
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want, outputs = [], []
    for r in docs.select("doc_id", "text").collect():
        *about, out = plain_fill(r.doc_id, r.text, 42, fim, spm)
        want.append((r.doc_id, *about, sha(out), sha(r.text or "")))
        outputs.append((r.doc_id, *about, out))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(fill_middle.digests(docs.repartition(3), 42, fim, spm).collect()) == order(want)
    assert order(fill_middle.transform(docs.repartition(2), 42, fim, spm).collect()) == order(outputs)


def test_fill_in_middle_one_shuffle(spark):
    plan = fill_middle.digests(messy(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_chunks_are_bounded_and_whole():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices(["é", "a", " ", "日", "word ", "\n"], k=rng.randint(0, 400))).encode()
        ends = fill_middle.unit_ends(text)
        assert len(ends) == len(re.findall(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text))
        lo = rng.randint(0, len(ends))
        hi = rng.randint(lo, len(ends))
        cut = text[int(ends[lo - 1]) if lo else 0:int(ends[hi - 1]) if hi else 0]
        assert b"".join(fill_middle.chunks(text, ends, lo, hi)) == cut


def test_fill_in_middle_empty(spark):
    none = messy(spark).limit(0)
    assert fill_middle.digests(none).count() == 0 and fill_middle.transform(none).count() == 0

"""Operators on rows of every odd kind against plain Python: nulls, empty and long texts, repeated rows and ids, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from sqlyard.llm import leaks, lm, packing, simhash, substring, tokenfiles, toxicity

random.seed(5)
WORDS = [f"w{i}" for i in range(40)] + ["Été", "naïve", "ß"]


def sentence(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


SHARED, LONG = sentence(30), sentence(3000)
COPY = sentence(60)
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, COPY), (7, COPY), (7, COPY), (8, COPY + " tail"), (9, f"{sentence(9)} {SHARED} x"),
    (10, f"y {SHARED}\n{sentence(4)}"), (11, LONG), (12, f"{LONG[:4000]} {sentence(20)}"), (13, SHARED), (None, SHARED), (None, None), (14, f"{SHARED} {SHARED}"),
    (20, "A b C d e f g h i j k l m"), (21, "a b c d e f g h i j k l m"), (22, "A b C d e f g h i j k l m n"), (23, "\x00odd\x0b words\x1chere\xa0now " * 12), (7, "another text of that id"),
    (30, sentence(13)), (31, "…" * 50),
] + [(100 + i, f"{sentence(i % 17)} {SHARED if i % 3 else ''} {sentence(i % 5)}") for i in range(60)]
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, True, [1]) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, key int, held boolean, spans array<int>").repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EMPTY)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- near copies ---------------------------------------------------------------------------------

def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, most=3):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= most:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_near_duplicates(docs, none):
    prints = [(i, slow_print(t)) for i, t in ROWS]
    groups = slow_groups({p for _, p in prints})
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[groups[p]].append(i)
    want = sorted(((i, f"{p:016x}", min(least[groups[p]], default=None)) for i, p in prints), key=repr)
    assert rows_of(simhash.near_duplicates(docs)) == want
    assert simhash.near_duplicates(none).collect() == []


def test_links_of_planted_bits(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints):
        for flips in (1, 2, 3, 4, 5):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    chain = [0]
    for b in range(30):
        chain.append(chain[-1] ^ (7 << 2 * b))
    prints = sorted(prints | set(chain))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for j, b in enumerate(signed) if i < j and bin(prints[i] ^ prints[j]).count("1") <= 3}
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for blocks in (4, 6, 7):
        assert {(r.a, r.b) for r in simhash.links(frame, 3, blocks).collect()} == want


# ---- repeats -------------------------------------------------------------------------------------

def slow_repeats(rows, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    holder = {}
    for (i, _), ws in zip(rows, words):
        for a in range(len(ws) - window + 1):
            if i is not None:
                key = tuple(ws[a: a + window])
                holder[key] = min(holder.get(key, i), i)
    out = []
    for (i, _), ws in zip(rows, words):
        gone = set()
        for a in range(len(ws) - window + 1):
            if i is not None and holder[tuple(ws[a: a + window])] < i:
                gone.update(range(a, a + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(docs, none):
    found = substring.remove_repeats(docs)
    assert rows_of(found.select("doc_id", "n_words", "n_removed", "kept_sha256")) == slow_repeats(ROWS)
    for r in found.where("n_removed > 0").collect():
        assert sum(s.stop - s.first for s in r.spans) == r.n_removed
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert substring.remove_repeats(none).collect() == []


def test_repeats_of_few_words(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(30), " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for _ in range(60)]
    frame = spark.createDataFrame(rows, EMPTY)
    got = rows_of(substring.remove_repeats(frame, 6, 3).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == slow_repeats(rows, 6)


# ---- benchmark -----------------------------------------------------------------------------------

ITEMS = [(1, SHARED), (2, "ONE"), (3, None), (4, ""), (None, "one two"), (12, SHARED[:80]), (5, sentence(12)), (6, "été"), (7, LONG[200:900])]


def slow_leaks(rows, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    phrases = {(item, tuple(ws[a: a + window])) for item, t in items for ws in [words(t)] for a in range(max(1, len(ws) - window + 1)) if ws}
    out = []
    for i, t in rows:
        ws, hit, owners = words(t), set(), set()
        for item, p in phrases:
            for a in range(len(ws) - len(p) + 1):
                if tuple(ws[a: a + len(p)]) == p:
                    hit.update(range(a, a + len(p)))
                    owners.add(item)
        names = ",".join(sorted(str(x) for x in owners if x is not None))
        out.append((i, len(ws), len(hit), len(owners), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_leaks(spark, docs, none, block_words):
    items = spark.createDataFrame([(i, t, "d") for i, t in ITEMS], "item_id long, text string, doc_id string")
    found = leaks.contamination(docs, items, block_words=block_words, shard_bytes=3000)
    assert rows_of(found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == slow_leaks(ROWS, ITEMS)
    for r in found.where("contaminated").collect():
        assert len(leaks.words(r.kept_text.encode())) == r.n_words - r.n_hit
    assert leaks.contamination(none, items).collect() == []
    assert not leaks.contamination(docs, items.limit(0)).where("contaminated").count()


# ---- packing -------------------------------------------------------------------------------------

def check_packing(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def first_fit(lengths, capacity):
    bins = []
    for n in lengths:
        k = next((k for k, gap in enumerate(bins) if gap >= n), None)
        if k is None:
            bins.append(capacity - n)
        else:
            bins[k] -= n
    return len(bins)


@pytest.mark.parametrize("capacity, group", [(64, 40_000), (4096, 40_000), (64, 25)])
def test_packing(docs, none, capacity, group):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    found = packing.pack_documents(docs, path, capacity=capacity, group_pieces=group).collect()
    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[a: a + capacity], "<u4")
            want.append((i, k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=repr) == sorted(want, key=repr)
    assert check_packing(found, capacity) <= first_fit(sorted((r.length for r in found), reverse=True), capacity) + (1 if group == 40_000 else 9)
    assert packing.pack_documents(none, path).collect() == []


def test_packed_ids(docs):
    for r in packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length


def test_packs_to_the_bound():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6, 1, 5000).astype(np.int64) + 1, 4096)
    bins, _ = packing.pack(lengths, 4096)
    assert bins.max() + 1 <= -(-lengths.sum() // 4096) + 1


# ---- token files ---------------------------------------------------------------------------------

@pytest.mark.parametrize("length, rows, width", [(2048, 64, 2), (16, 3, 4)])
def test_token_files(spark, docs, none, tmp_path, length, rows, width):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    manifest = tokenfiles.write(docs, f"file://{tmp_path}/files", path, length=length, rows=rows, width=width)
    got = tokenfiles.read(spark, manifest).collect()
    want, start = [], 0
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == want
    for r in manifest.collect():
        file = tokenfiles.open_sequences(f"{r.path}.arrows")
        assert sum(file[k][1].true_count for k in range(len(file))) == r.n_tokens
        if len(file):
            ids, mask = file[len(file) - 1]
            assert len(ids) == len(mask) == length and not ids.flags.owndata
        with pa.memory_map(f"{r.path}.arrows".removeprefix("file://")) as source:
            assert pa.ipc.open_stream(source).read_all().num_rows == len(file)
    assert tokenfiles.write_and_read(none, path).collect() == []


# ---- toxicity and likelihood -----------------------------------------------------------------------

def test_toxicity_of_unseen_spellings(spark):
    rng = random.Random(1)
    rude = [s + e for s in ("glorp", "vrexil", "snudd") for e in ("a", "en", "ist", "ost", "ung", "ard")]
    rows = []
    for i in range(700):
        words = sentence(rng.randrange(5, 120)).split()
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(rude[:-1] if i < 600 else ["vrexilost", "glorpung", "snuddler"]))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows if i < 600] + [(5000, 1, 0), (3, None, 1)], "doc_id long, toxic int, text int")
    found = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    fresh = [(found[i].predicted, y) for i, _, y in rows if i >= 600 or found[i].held_out]
    assert sum(p == y for p, y in fresh) / len(fresh) > 0.93


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i == 9)) for i, _ in ROWS if i], "doc_id long, toxic int")
    found = toxicity.score(docs, labels).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.predicted == 0 for r in toxicity.score(docs, labels.where("toxic = 0")).collect())
    assert len(toxicity.score(docs, labels.limit(0)).collect()) == len(ROWS)
    assert toxicity.score(none, labels).collect() == []


def test_likelihood(spark, docs, none):
    rng = random.Random(2)
    follows = {w: WORDS[(i * 7 + 3) % len(WORDS)] for i, w in enumerate(WORDS)}
    rows = []
    for i in range(400):
        words = [rng.choice(WORDS)]
        for _ in range(200):
            words.append(follows[words[-1]] if rng.random() < 0.9 else rng.choice(WORDS))
        rows.append((i, " ".join(words)))
    mixed = " ".join(random.Random(4).sample(rows[0][1].split(), 201))
    found = {r.doc_id: r for r in lm.score(spark.createDataFrame([*rows, (999, mixed)], EMPTY)).collect()}
    assert found[0].mean_log_likelihood > found[999].mean_log_likelihood + 1
    assert abs(found[0].log_likelihood / found[0].n_tokens - found[0].mean_log_likelihood) < 1e-5
    odd = lm.score(docs).collect()
    assert len(odd) == len(ROWS) and all(r.n_tokens or r.log_likelihood == 0 and r.mean_log_likelihood is None for r in odd)
    assert lm.score(none).collect() == []


def test_likelihood_of_every_word(spark):
    """Against sums of softmax by softmax, on a corpus with more words than classes."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(vocabulary[min(int(rng.expovariate(0.02)), 299)] for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(i, f"one{i} two{i} same") for i in range(100, 140)] + [(7, None), (None, "same v1 v2"), (7, "same v1 v2")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, share int").repartition(3)
    model = lm.fit(docs, breadth=4)
    (keys, numbers), side = model.frequent.value, model.side
    by_key, shares_by_key = dict(zip(keys.tolist(), numbers.tolist())), {r["word"]: r["share"] for r in model.shares.collect()}
    counts = defaultdict(int)
    for _, t in rows:
        for w in (t or "").encode().split():
            counts[w] += 1
    own = {w: by_key[lm.word_key(w)] for w in counts if lm.word_key(w) in by_key}
    shares = {w: shares_by_key[lm.word_key(w)] for w in counts if w not in own}
    assert len(counts) == len(by_key) + len(shares_by_key) > side * side and sorted(own.values()) == list(range(1, len(own) + 1))
    assert min(counts[w] for w in own) >= max(counts[w] for w in shares)
    of = {w: own.get(w) or model.first + lm.word_key(w) % 2**64 % model.shared for w in counts}
    for w, share in shares.items():
        assert abs(share - np.log(counts[w] / sum(n for v, n in counts.items() if v not in own and of[v] == of[w]))) < 1e-12
    net = lm.Network(side, side, model.dim, model.reach).fill(model.flat)

    def slow(words):
        total, padded = 0.0, [0] * model.reach + [of[w] for w in words] + [0] * model.reach
        for i, w in enumerate(words):
            near = [padded[i + model.reach + j] for j in net.places()]
            hidden = np.tanh(sum(net.tables[k][c].astype(float) for k, c in enumerate(near)))
            for logits, place in ((hidden @ net.to_group + net.group_bias, of[w] // side), (hidden @ net.to_member[of[w] // side] + net.member_bias[of[w] // side], of[w] % side)):
                total += logits[place] - np.log(np.exp(logits).sum())
            total += shares.get(w, 0.0)
        return total

    got = model.score().collect()
    assert len(got) == len(rows)
    for r in got:
        near = [slow((t or "").encode().split()) for i, t in rows if i == r.doc_id and len((t or "").split()) == r.n_tokens]
        assert min(abs(r.total - x) for x in near) < 1e-3
    assert len({round(r.total, 5) for r in got if (r.doc_id or 0) >= 100}) > 20


def test_classes_follow_the_vocabulary():
    assert [lm.shape(n) ** 2 for n in (0, 1, 50, 10**4, 10**6, 10**8)] == sorted(lm.shape(n) ** 2 for n in (0, 1, 50, 10**4, 10**6, 10**8))
    assert lm.shape(10**9) ** 2 > 8 * lm.shape(10**6) ** 2 > 64 * lm.shape(10**3) ** 2


def test_network_slopes():
    net = lm.Network(3, 4, 3, 2)
    net.fill(np.random.default_rng(0).normal(0, 0.5, net.flat().size))
    tokens = np.array([0, 0, 1, 2, 11, 4, 5, 6, 1, 0, 0])
    at = np.arange(2, 9)
    seen = net.flat().astype(np.float64)
    rates = [np.zeros_like(p) for p in net.parameters()]
    before = -net.log_probabilities(tokens, at).mean()
    net.learn(tokens, at, rates, 1e-3)
    assert -net.log_probabilities(tokens, at).mean() < before
    slope = np.sqrt(np.concatenate([r.ravel() for r in rates]))

    def loss(k, by):
        moved = seen.copy()
        moved[k] += by
        return -lm.Network(3, 4, 3, 2).fill(moved).log_probabilities(tokens, at).mean()

    for k in np.random.default_rng(1).choice(len(seen), 60, replace=False):
        assert abs(abs(loss(k, 1e-2) - loss(k, -1e-2)) / 2e-2 - slope[k]) < 2e-3


def test_masked_token_is_not_seen():
    net = lm.Network(3, 4, 3, 2)
    a, b = np.array([0, 0, 1, 2, 3, 4, 5, 0, 0]), np.array([0, 0, 1, 2, 6, 4, 5, 0, 0])
    assert np.allclose(net.hidden(a, np.array([4])), net.hidden(b, np.array([4])))
    every = [net.log_probabilities(np.array([0, 0, 1, 2, c, 4, 5, 0, 0]), np.array([4]))[0] for c in range(12)]
    assert abs(np.exp(every).sum() - 1) < 1e-5

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from corpuslab.llm import bigru, bpe, brown, chat, common, cuckoo, licenses, near, queries, rules, tokens, winnow
from corpuslab.session import Scratch

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CLASHING = "row string, key int, ws int, size string, vid int, score string, n int, sig string, held_out int, label string, held int, bands int, start int, word int, predicted int, item_id int"
LONG = " ".join(f"w{i % 977} of" for i in range(9000)) + " apache license"
TEXTS = [
    None, "", " ", "\n\t ", "a", "The MIT License.", "the mit license", "Released under the MIT License.", "x  y\tz", "x y z", " x y z", "naïve Été été 日本語 text </s> <|endoftext|> x",
    "one two three four five six seven eight nine ten eleven twelve", "ONE two three four five six seven eight nine ten eleven twelve thirteen", "İstanbul K k", LONG, LONG + " end", "is " * 50, "idiot idiot",
]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


@pytest.fixture(scope="module")
def rows():
    """Ids with a null one and a repeated row."""
    out = [(i if i != 9 else None, t) for i, t in enumerate(TEXTS)]
    return [*out, out[5], (100, TEXTS[12]), (101, "is " * 50)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    width = CLASHING.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], f"doc_id long, text string, {CLASHING}").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(12)] + [(None, 1, 1), (3, None, None), (4, 0, 1)], "doc_id long, quality int, toxic int")


def same(df, want, *columns):
    got = sorted(str([r[c] for c in columns]) for r in df.collect())
    assert got == sorted(str(list(w)) for w in want)


def test_bpe_is_the_library(docs, rows):
    t = Tokenizer.from_file(BPE)

    def one(i, x):
        ids = t.encode(x or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), text == (x or "")

    same(bpe.round_trip(docs, BPE), [one(*r) for r in rows], "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same_text")
    back = bpe.decode(bpe.encode(docs, BPE), BPE)
    same(back, [(i, x or "") for i, x in rows], "doc_id", "text")


def test_bpe_pairs_and_repairs():
    b, t = bpe.encoder(BPE), Tokenizer.from_file(BPE)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abthein g'\n日é😀1²"), rng.integers(1, 30))) for _ in range(800)] + ["ab" * 400, "a" * 513]
    for w, packed in zip(words, b.encode(words)):
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == t.encode(w).ids and b.decode(packed) == w
    assert b.decode(np.array([50_000_000, 0], "<u4").tobytes()) == "!"
    # speculation alone would be wrong for some of them
    data = [w.encode() for w in words[:800]]
    word, token = b.greedy(data)
    assert any(token[word == i].tolist() != b.merged_long(w) for i, w in enumerate(data))


@pytest.mark.parametrize("chunk,overlap", [(200, 3), (1000, 64)])
def test_token_counts_are_the_library(docs, rows, chunk, overlap):
    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((x or "").encode()), len(m.encode(x or "")), len(m.encode(x or "")) > 50) for i, x in rows]
    same(tokens.count_tokens(docs, PIECES, chunk=chunk, overlap=overlap, limit=50), want, "doc_id", "n_bytes", "n_tokens", "over_limit")


def test_token_counts_without_borders(spark):
    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["a" * 3000, "=" * 2500, "日本" * 700, " " * 1500, "ab" * 900 + " x " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    same(tokens.count_tokens(df, PIECES, chunk=256, overlap=8), [(i, len(m.encode(t))) for i, t in enumerate(texts)], "doc_id", "n_tokens")


def test_licences_against_brute_force(docs, rows):
    spec = licenses.template_words(licenses.TEMPLATES)

    def one(i, t):
        ws = WORD.findall(lower(t))
        hits = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(ws)) if ws[k : k + len(p.split())] == p.split()]
        best, found = 0.0, set()
        for a in range(0, len(ws), licenses.STEP):
            block = set(ws[a : a + licenses.BLOCK])
            for label, tw in spec.items():
                share = len(block & set(tw)) / len(tw)
                if share >= 0.8 - 1e-9:
                    found.add(label)
                    best = max(best, share)
        base = {x for _, x in hits}
        starts = [k for k, _ in hits]
        return i, len(ws), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if hits else best

    same(licenses.scan(docs), [one(*r) for r in rows], "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def brute_hits(rows, items):
    wins = {}
    for item, t in items:
        ws = WORD.findall(lower(t))
        for k in range(max(1, len(ws) - 9) if ws else 0):
            wins.setdefault(tuple(ws[k : k + 10]), set()).add(str(item) if item is not None else "null")
    out = []
    for i, t in rows:
        ws = WORD.findall(lower(t))
        hit, own = set(), set()
        for n in {len(w) for w in wins}:
            for k in range(len(ws) - n + 1):
                if found := wins.get(tuple(ws[k : k + n])):
                    hit |= set(range(k, k + n))
                    own |= found
        out.append((i, len(ws), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize(
    "items",
    [
        [(3, "two three four five six seven eight nine ten eleven twelve thirteen"), (20, "One Two three four five six seven eight nine ten"), (None, "été 日本語"), (4, None), (5, ""), (6, "is is is is is is is is is is is"), (7, "w3 of w4 of w5 of w6 of w7")],
        [],
    ],
)
def test_decontamination_against_brute_force(spark, docs, rows, items):
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id int, text string, doc_id int")
    same(winnow.decontaminate(docs, bench), brute_hits(rows, items), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_exact_dedup_against_brute_force(docs, rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    want = []
    for (i, _), t in zip(rows, norm):
        keep = min((x for x in groups[t] if x is not None), default=None)
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    same(cuckoo.exact_dedup(docs), want, "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_cuckoo_shard_grows_and_forgets():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    shard = cuckoo.CuckooShard(2)
    for i, k in enumerate(keys):
        shard.insert(k, i)
    shard.insert(keys[5], 1)
    assert shard.n > 500 and all(shard.find(k) == i for i, k in enumerate(keys)) and shard.ids[5] == 1 and shard.live[5] == 2
    assert shard.delete(keys[5]) and shard.find(keys[5]) == 5 and shard.delete(keys[5]) and shard.find(keys[5]) == -1
    assert not shard.delete(keys[5])
    again = cuckoo.CuckooShard.load(shard.frame(0))
    assert all((again.find(k) >= 0) == (i != 5) for i, k in enumerate(keys))


def test_cuckoo_index_updates(spark):
    key = lambda i: hashlib.sha256(str(i).encode()).digest()
    frame = lambda ids: spark.createDataFrame([(i, key(i)) for i in ids], "doc_id long, sha binary")
    index = cuckoo.build_index(frame([*range(200), 7, 7]), 4)
    after = cuckoo.update_index(index, 4, frame([300, 7]), frame([0, 7, 999]))
    got = {bytes(r["sha"]): r["live"] for r in after.collect()}
    assert got == {key(i): 3 if i == 7 else 1 for i in [*range(1, 200), 300]}


def test_quality_learns_only_from_its_folds(spark, docs, labels):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in rules.classify(d, lab).collect()}
    truth = {r["doc_id"]: r["quality"] for r in lab.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.95
    flipped = lab.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    assert {r["doc_id"]: r["score"] for r in rules.classify(d, flipped).collect()} == {i: r["score"] for i, r in got.items()}
    out = rules.classify(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in rules.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_rules_compile_to_what_they_hold(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.5)).astype(float)
    found, intercept = rules.fit(x, y)
    z = intercept + sum(w * rules._holds(x, r) for r, w in found)
    assert ((z > 0) == (y == 1)).mean() > 0.97 and len(found) < len(rules.tree_rules(x, y)) / 4
    df = spark.createDataFrame(x[:50].tolist(), "a double, b double, c double").select(rules.compiled(found, intercept, ["a", "b", "c"]).alias("p"))
    assert np.allclose([r["p"] for r in df.collect()], 1 / (1 + np.exp(-z[:50])))


def test_toxicity_network_gradients():
    net = bigru.Network({b"x": 0}, np.zeros(2), np.zeros(1 << bigru.NGRAM_BITS))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3, bigru.WINDOW, bigru.WORD_DIM + bigru.CHAR_DIM + 1))
    mask = np.arange(bigru.WINDOW)[None, :] < np.array([32, 5, 1])[:, None]
    weight = np.array([1.0, -2.0, 0.5])

    def loss():
        gates = np.concatenate([x @ net.p["wf"] + net.p["bf"], x @ net.p["wb"] + net.p["bb"]], 2)
        keep = {}
        return float(net.forward(gates, mask, keep) @ weight), keep

    _, keep = loss()
    grad, dx = net.backward(weight, mask, keep, x)
    for name, at in [("wf", (2, 5)), ("ub", (3, 20)), ("uf", (1, 1)), ("a", (4, 2)), ("v", (3,)), ("o", (5,)), ("bb", (7,)), ("c", (1,))]:
        was = net.p[name][at]
        net.p[name][at] = was + 1e-3
        up = loss()[0]
        net.p[name][at] = was - 1e-3
        down = loss()[0]
        net.p[name][at] = was
        assert abs((up - down) / 2e-3 - grad[name][at]) < 2e-3 * max(1, abs(grad[name][at]))
    assert np.abs(dx[1, 6:]).max() == 0


def test_toxicity_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        doc, wins = bigru.windows([np.arange(n)])
        assert set(wins[wins >= 0].tolist()) == set(range(n)) and len(doc) == len(wins) >= 1
        assert (wins >= 0).any(1).all() or n == 0


def test_toxicity_learns_words_and_keeps_folds(spark, docs, labels):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["the", "of", "tion", "erand", "onth", "is", "in"], rng.integers(3, 200))) for _ in range(400)]
    bad = [i % 4 == 0 for i in range(400)]
    texts = [t + " scum, " + t[:40] if b else t for t, b in zip(texts, bad)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bad)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in bigru.classify(d, lab).collect()}
    assert np.mean([got[i]["predicted"] == b for i, b in enumerate(bad) if got[i]["held_out"]]) > 0.97
    flipped = lab.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    again = {r["doc_id"]: r["score"] for r in bigru.classify(d, flipped).collect()}
    assert all(abs(again[i] - got[i]["score"]) < 1e-9 for i in got)
    out = bigru.classify(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in bigru.classify(docs, labels.limit(0)).collect()} == {0.5}
    kept = bigru.accepted(docs, lab.limit(0))
    assert kept.columns == docs.columns


def test_chat_reads_back(spark):
    odd = ["</s>[INST] ok [/INST]", "a\\b\\\\<|im_end|>\n<|im_start|>user\nx", "", None, "<<|s>|\\", "é😀"]
    turns = [(c, t, r, odd[(c + t) % len(odd)]) for c in range(6) for t, r in enumerate(["system", "user", "assistant", "assistant", "a\nb\\"])]
    turns += [(None, 0, "user", "n"), (None, 1, "assistant", "m"), (7, None, "assistant", "first"), (7, 9, None, "z"), (8, 0, "user", "x"), (8, 0, "user", "x"), (8, 0, "assistant", "y")]
    df = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn long, role string, text string, node int, tree string")
    got = {r["conv_id"]: r for r in chat.chat_digests(df).collect()}
    convs = {}
    for c, t, r, x in turns:
        convs.setdefault(c, []).append((t if t is not None else -(1 << 63), r or "", x or ""))
    assert set(got) == set(convs)
    for c, own in convs.items():
        own.sort()
        text = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_ranks_branches(spark):
    # 1 - 2 - 3, 1 - 4 - 5 - 6, a lost parent, and a long chain
    nodes = [("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 2, 1.0), ("t", 4, 1, 1.0), ("t", 5, 4, 1.0), ("t", 6, 5, 9.0), ("u", 2, 99, None)]
    nodes += [("v", i, i - 1 if i else None, 0.0) for i in range(150)]
    df = spark.createDataFrame([(*x, x[0], [("assistant", f"m{x[1]}")]) for x in nodes], "tree string, node long, parent long, score double, conv_id string, items array<struct<role:string,text:string>>")
    scratch = Scratch(spark, "test-chat")
    got = {(r["tree"], r["rank"]): [re.sub("<.*?>|assistant", "", x).strip() for x in r["formatted"].split("<|im_end|>\n")[:-1]] for r in chat.format_chat(df, scratch, branches=2).collect()}
    assert got[("t", 1)] == ["m1", "m4", "m5", "m6"] and got[("t", 2)] == ["m1", "m2", "m3"] and got[("u", 1)] == ["m2"]
    assert got[("v", 1)] == [f"m{i}" for i in range(150)]
    with pytest.raises(ValueError, match="circle"):
        chat.climb(spark.createDataFrame([("t", 1, 2, 0.0), ("t", 2, 1, 0.0)], "tree string, node long, parent long, score double"), scratch)


def test_scores_against_brute_force(docs, rows):
    train = Counter()
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            train.update([*(t or "").encode().lower().split(), b""])
    n, v = sum(train.values()), len(train)
    got = sorted(brown.score_documents(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"]))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0], len((r[1] or "").split())))
    assert len(got) == len(want)
    for r, (i, t) in zip(got, want):
        ws = [*(t or "").encode().lower().split(), b""]
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, len(ws), sum(w in train for w in ws), n)
        assert abs(r["base_score"] - sum(log10((train[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6 * len(ws)
        assert r["score"] < 0


def test_scores_do_not_depend_on_what_tasks_hold(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    base = {r["doc_id"]: r for r in brown.score_documents(d, clustered=300).collect()}
    whole = {i: r["score"] for i, r in base.items()}
    part = {r["doc_id"]: r["score"] for r in brown.score_documents(d, clustered=300, held_words=400).collect()}
    assert all(abs(whole[i] - part[i]) < 1e-6 * abs(whole[i]) for i in whole)
    held = [r for r in base.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_outside_the_exchange_get_classes_from_their_neighbours(spark):
    rng = np.random.default_rng(6)
    # rare words of one length: those of the first kind stand after "aa" and before "bb", the others the other way round
    texts = []
    for i in range(1200):
        ws = []
        for _ in range(12):
            k = int(rng.integers(0, 200))
            ws += ["aa", f"u{k:03}", "bb"] if k % 2 else ["bb", f"v{k:03}", "aa"]
        texts.append((i, " ".join(ws)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)

    def held_out(**more):
        got = [r for r in brown.score_documents(df, clustered=20, classes=8, **more).collect() if r["held_out"]]
        return sum(r["score"] for r in got) / sum(r["n_tokens"] for r in got)

    assert held_out() > held_out(moves=0) + 0.1


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    # words 0-9 are followed by 10-19 and the other way round
    counts = np.zeros((21, 21))
    for a in range(20):
        for b in range(20):
            if (a < 10) != (b < 10):
                counts[a, b] = rng.integers(5, 20)
    at = brown.exchange(counts, 20, 2)
    assert len(set(at[:10])) == 1 and len(set(at[10:20])) == 1 and at[0] != at[10]


def test_exchange_ends_where_no_move_helps():
    counts = np.random.default_rng(0).integers(0, 9, (15, 15)).astype(float)

    def likelihood(at):
        m = np.zeros((at.max() + 1,) * 2)
        np.add.at(m, (at[:, None].repeat(15, 1), at[None, :].repeat(15, 0)), counts)
        return sum(np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0).sum() * sign for x, sign in ((m, 1), (m.sum(0), -1), (m.sum(1), -1)))

    at = brown.exchange(counts, 12, 4, rounds=50)
    for w in range(12):
        for k in range(4):
            moved = at.copy()
            moved[w] = k
            assert likelihood(moved) <= likelihood(at) + 1e-6


def brute_components(rows):
    sets = []
    for _, t in rows:
        ws = (t or "").encode().lower().split()
        sets.append(frozenset(zip(ws, ws[1:])) if len(ws) > 1 else frozenset([tuple(ws)]) if ws else frozenset())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            up[root(i)] = root(j)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if root(m) == root(k) and rows[m][0] is not None]
        comp = min(ids, default=None)
        out.append((i, len(sets[k]), comp, i == comp))
    return out


def test_near_duplicates_against_brute_force(spark, docs, rows):
    same(near.near_duplicates(docs), brute_components(rows), "doc_id", "n_shingles", "component_id", "kept")
    rng = np.random.default_rng(8)
    base = [rng.choice([f"w{i}" for i in range(60)], 120).tolist() for _ in range(12)]
    made = []
    for i in range(300):
        ws = list(base[i % 12 if i % 3 else 0])
        for k in rng.integers(0, 120, rng.integers(0, 14)):
            ws[k] = f"x{rng.integers(0, 9)}"
        made.append((i, " ".join(ws)))
    df = spark.createDataFrame(made, "doc_id long, text string")
    same(near.near_duplicates(df), brute_components(made), "doc_id", "n_shingles", "component_id", "kept")


def brute_kept_words(rows, size):
    """Ids that near dedup over word ``size``-grams keeps: the smallest of each component."""
    sets = {}
    for i, t in rows:
        ws = (t or "").encode().lower().split()
        sets[i] = {tuple(ws[k : k + size]) for k in range(max(1, len(ws) - size + 1))} if ws else set()
    comp = {i: i for i in sets}
    for i, j in combinations(sorted(sets), 2):
        if sets[i] and sets[j] and comp[i] != comp[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            lo, hi = sorted((comp[i], comp[j]))
            comp = {k: lo if c == hi else c for k, c in comp.items()}
    return {i for i, c in comp.items() if i == c}


def test_near_dedup_stage_takes_five_words(spark):
    base = [f"w{i}" for i in range(100)]
    scattered = [f"x{i}" if i % 20 == 10 else w for i, w in enumerate(base)]  # 0.82 on word pairs, 0.59 on five words
    together = [f"y{i}" if 50 <= i < 53 else w for i, w in enumerate(base)]  # 0.86 on five words
    rows = [(1, " ".join(base)), (2, " ".join(scattered)), (3, " ".join(together)), (4, "a b c"), (5, "a  b c"), (6, ""), (7, None)]
    rng = np.random.default_rng(5)
    for i in range(10, 150):
        ws = list(base[: 60 + i % 2 * 40])
        for k in rng.integers(0, len(ws), rng.integers(0, 6)):
            ws[k] = f"z{rng.integers(0, 50)}"
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert got == brute_kept_words(rows, 5) and got != brute_kept_words(rows, 2)
    few = rows[:7]
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df.where("doc_id < 10"), "").collect()}
    assert got == brute_kept_words(few, 5) == {1, 2, 4, 6, 7}
    assert {r["doc_id"] for r in near.near_duplicates(df.where("doc_id < 10"), size=2).where("kept").collect()} == brute_kept_words(few, 2) == {1, 4, 6, 7}
    with pytest.raises(ValueError, match="threshold"):
        near.near_duplicates(df, threshold=50)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    sets = [a, np.concatenate([a[:360], np.unique(rng.integers(0, 1 << 63, 40).astype(np.uint64))]), a[:1], a[:3], np.zeros(0, np.uint64)]
    s = near.sketches(sets)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (s[:4] != top).all() and (s[4] == top).all()
    want = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
    assert abs((s[0] == s[1]).mean() - want) < 0.1
    # each set alone gives the same sketch
    assert all((near.sketches([x])[0] == y).all() for x, y in zip(sets, s))


@pytest.mark.parametrize("name", ["op1_bpe_encode_decode", "op2_license_scan", "op3_token_counts", "op6_exact_dedup", "op10_minhash_near_dedup"])
def test_empty_tables(spark, tmp_path, name):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_empty_tables_of_the_others(docs, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    assert rules.classify(none, no_labels).count() == 0
    assert winnow.decontaminate(none, docs.select("item_id", "text").limit(0)).count() == 0
    assert bigru.classify(none, no_labels).count() == 0
    assert brown.score_documents(none).count() == 0
    turns = docs.selectExpr("doc_id AS conv_id", "doc_id AS turn", "text AS role", "text").limit(0)
    assert chat.chat_digests(turns).count() == 0


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    sf = str(tmp_path)
    d = spark.read.parquet(f"{SF}/documents.parquet")
    item = "bench one two three four five six seven eight nine ten eleven"
    clean = "entirely different words that stand alone in this small corpus and are not repeated by any other text at all"
    extra = spark.createDataFrame([(90001, clean), (90002, clean), (90003, clean + "  "), (90004, f"before {item} after"), (90005, clean + " more")], "doc_id long, text string")
    d.select("doc_id", "text", "lang", "source", "n_chars").unionByName(extra, allowMissingColumns=True).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "near dedup", "benchmark decontamination", "BPE encoding and decoding"]
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        path = f"{sf}/{name.replace(' ', '-')}"
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        ids = {r["doc_id"] for r in after.collect()}
        if name == "toxicity":
            toxic = {r["doc_id"] for r in bigru.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
            assert ids == {i for i, _ in rows} - toxic
        elif name == "exact dedup":
            first = {}
            for i, t in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
            assert ids == set(first.values())
        elif name == "near dedup":
            assert ids == brute_kept_words(rows, 5)
        elif name == "benchmark decontamination":
            assert ids == {r[0] for r in brute_hits(rows, [(1, item)]) if not r[-1]} and 90004 not in ids
        else:
            assert ids == {i for i, _ in rows} and after.where("same_text").count() == len(rows)
        if name != "BPE encoding and decoding":
            assert after.columns == docs.columns
        docs = after


ITEM = "bench one two three four five six seven eight nine ten eleven"


def test_pipeline_judges_rows_and_not_ids(spark, tmp_path):
    near_by = [f"w{i}" for i in range(60)]
    changed = " ".join(["other", *near_by[1:]])
    # an id with a copy and a text of its own, null ids, a copy under one id, and a very long text
    rows = [
        (5, "one text of its own"), (7, "one text  of its own"), (5, "what only the second row of five says"), (None, "one text of its own"),
        (None, f"unknown {ITEM} source"), (None, "only a null id says this"), (None, "only a null id says this"), (8, "x y z"), (8, "x y z"),
        (9, f"nine {ITEM}"), (9, "nine is clean here"), (None, " ".join(near_by)), (11, changed), (11, "eleven and more"), (12, None), (13, ""), (None, None),
        (14, LONG), (15, LONG + " " + ITEM),
    ]
    width = CLASHING.count(",") + 1
    extra = "_row int, __row int, _n int, kept boolean, contaminated string"
    docs = spark.createDataFrame([(*r, *[None] * width, 1, None, 3, True, "c") for r in rows], f"doc_id long, text string, {CLASHING}, {extra}").repartition(4)
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def left(stage):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        return Counter((r["doc_id"], " ".join((r["text"] or "").split())) for r in out.collect())

    def least(groups):
        return Counter(min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups)

    own = [(i, " ".join((t or "").split())) for i, t in rows]
    by_text = {}
    for i, t in own:
        by_text.setdefault(t, []).append((i, t))
    assert left(corpus_pipeline.exact_dedup) == least(by_text.values())
    shingles = [frozenset(tuple(t.lower().split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))) if t else frozenset([k]) for k, (_, t) in enumerate(own)]
    comp = list(range(len(own)))
    for a, b in combinations(range(len(own)), 2):
        if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b]):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    stay = left(corpus_pipeline.near_dedup)
    assert stay == least([own[k] for k in range(len(own)) if comp[k] == c] for c in set(comp)) and (None, " ".join(near_by)) not in stay
    assert left(corpus_pipeline.decontamination) == Counter(x for x in own if ITEM not in x[1])
    # without labels every score is 0.5, which is predicted toxic; what is asked here is that rows and columns pass through
    assert sum(left(corpus_pipeline.toxicity).values()) in (0, len(own))
    done = corpus_pipeline.bpe_round_trip(spark, docs, str(tmp_path)).select("doc_id", "same_text").collect()
    assert Counter(r["doc_id"] for r in done) == Counter(i for i, _ in rows) and all(r["same_text"] for r in done)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    for name, of in (("documents", docs), ("benchmark", spark.createDataFrame([], "item_id long, text string")), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int"))):
        of.write.parquet(f"{tmp_path}/{name}.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_neighbours_of_frequent_words_may_take_several_rows(spark, monkeypatch):
    d = spark.read.parquet(f"{SF}/documents.parquet")

    def scores():
        return {r["doc_id"]: round(r["score"], 6) for r in brown.score_documents(d, clustered=30, held_words=900, classes=8).collect()}

    whole = scores()
    monkeypatch.setattr(brown, "ROW_WORDS", 20)
    monkeypatch.setattr(brown, "FLUSH_PAIRS", 2000)
    assert scores() == whole
    few = {r["doc_id"]: r["score"] for r in brown.score_documents(d, clustered=30, held_words=900, classes=8, known_words=50).collect()}
    assert few.keys() == whole.keys() and all(s < 0 for s in few.values())


def test_class_matrix_counts_every_pair(spark):
    """The matrix from the neighbours is that of the classes of all neighbouring words."""
    texts = [(i, " ".join(f"w{(i * i + j * j * j) % 23}" for j in range(i % 17))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    count = Counter(w for _, t in texts for w in t.split())
    held = sorted(count, key=lambda w: (-count[w], w))[:12]
    rest = sorted(set(count) - set(held))[:-3]
    at = np.concatenate([np.arange(5) % 3, np.arange(3, 3 + brown.LENGTHS + 1)])
    keys = np.sort(brown.rest_keys([w.encode() for w in rest]))
    words = brown.Known(held, 5, keys, at)
    rng = np.random.default_rng(1)
    classes = np.concatenate([at[:5], rng.integers(0, 9, 7), at[-1:], rng.integers(0, 9, len(keys))]).astype(np.uint8)
    want = np.zeros((16, 16), int)
    fixed = np.zeros((16, 16), int)
    for _, t in texts:
        place, symbol, _, flat = words.of([t])
        numbers = words.numbers(place, symbol, flat)
        own = brown.classes_of(numbers, classes)
        for a, b, x, y in zip([int(at[-1]), *own], own, [12, *numbers], numbers):
            want[a, b] += 1
            fixed[a, b] += all(0 <= z < 5 or z == 12 for z in (x, y))
    send = spark.sparkContext.broadcast
    near = brown.neighbours(df, send((held, 5)), send(keys), at, np.append(np.arange(12) % 3 + 1, 1))
    assert (brown.class_matrix(near, send(classes), 5, 12, fixed) == want).all()


def test_words_beyond_the_tables_of_tasks_move_as_well(spark, monkeypatch):
    """How many words tasks hold decides no class: those beyond move by joins."""
    d = spark.read.parquet(f"{SF}/documents.parquet")

    def scores(**more):
        return {r["doc_id"]: round(r["score"], 6) for r in brown.score_documents(d, clustered=30, classes=8, **more).collect()}

    whole = scores()
    monkeypatch.setattr(brown, "ROW_WORDS", 20)
    monkeypatch.setattr(brown, "READ_TOKENS", 500)
    for held, tabled in ((900, 400), (60, 0)):
        assert scores(held_words=held, table_words=tabled) == whole
    assert scores(held_words=900, known_words=400) != whole


def test_only_words_beyond_the_tables_that_stand_side_by_side_are_joined(spark, monkeypatch):
    """Pairs of a word with words that tasks hold are in none of the joins of the rounds."""
    rng = np.random.default_rng(5)
    texts = []
    for i in range(300):
        ws = [f"w{int(rng.integers(0, 40)):02}" for _ in range(20)]
        ws[3:3] = [f"once{i}"]
        if i % 10 == 0:
            ws[9:9] = [f"pair{i}", f"of{i}"]
        texts.append((i, " ".join(ws)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)

    def scores():
        return {r["doc_id"]: round(r["score"], 6) for r in brown.score_documents(df, clustered=10, held_words=20, classes=4).collect()}

    whole = scores()
    joined, with_classes = [], brown.with_classes

    def seen(pairs, rare):
        joined.append({tuple(r)[:2] for r in pairs.collect()})
        return with_classes(pairs, rare)

    monkeypatch.setattr(brown, "with_classes", seen)
    monkeypatch.setattr(brown, "ONCE", 0)
    assert scores() == whole
    pairs = [i for i in range(0, 300, 10) if zlib.crc32(str(i).encode()) % 7 != 2]
    words = {int(k) for i in pairs for k in brown.rest_keys([f"pair{i}".encode(), f"of{i}".encode()])}
    assert joined and all({w for w, _ in seen} == words for seen in joined)


def test_words_and_their_ends_are_taken_apart_by_arrow():
    texts = ["", " ", "a b", "  A\x0b\x0cb\x1cc\x85d \r\n\tÉ ÀB x ", "\x00", "\x1f a", None, "a a"]
    want = [[*common.words_of(t or ""), b""] for t in texts]
    assert brown.ended_words(pa.array(texts, pa.string())).cast(pa.list_(pa.binary())).to_pylist() == want
    symbols = brown.Symbols(["a", "b"], 1)
    place, _, text, flat = symbols.of(texts)
    words = [w for ws in want for w in ws]
    assert place.tolist() == [{b"a": 0, b"b": 1, b"": -2}.get(w, -1) for w in words]
    assert text.tolist() == [i for i, ws in enumerate(want) for _ in ws]
    assert brown.loose_keys(flat, place == -1).tolist() == brown.rest_keys([w for w in words if w not in (b"a", b"b", b"")]).tolist()


def test_sums_by_one_number_are_those_by_several_keys():
    rng = np.random.default_rng(3)
    n = rng.integers(1, 9, 500)
    for keys in ([rng.integers(-5, 5, 500), rng.integers(0, 4, 500)], [rng.integers(-(1 << 63), (1 << 63) - 1, 20)[rng.integers(0, 20, 500)], rng.integers(0, 4, 500)]):
        want = Counter()
        for *k, m in zip(*keys, n):
            want[tuple(map(int, k))] += int(m)
        a, b, sums = brown.summed(keys, n)
        assert list(zip(a.tolist(), b.tolist(), sums.tolist())) == [(*k, want[k]) for k in sorted(want)]

"""Manifest, prefix trie and language identification against brute force; identity of words; permutations; recall."""

import collections
import hashlib
import itertools
import math
import random
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from trisketch.llm import embedding_dedup as ed
from trisketch.llm import langid, lm, merkle, ngram_join, pii, prefix_trie, substring_dedup
from trisketch.llm import token_counts as tc
from trisketch.llm import words as w
from trisketch.llm.shipping import ship

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture(scope="module")
def session(spark):
    return ship(spark)


# ---- manifest ----------------------------------------------------------------

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, rank int, path string"


def manifest_rows(seed, n):
    rng = random.Random(seed)
    rows = [(i, f"Text {i} É" * rng.randint(0, 3), rng.choice(["en", None]), rng.choice([None, "", "a", "ä", "b"]), i, "h", 1, "p") for i in range(n)]
    odd = [(None, None, None, None, None, "h", 1, "p"), (3, "Text", "en", "a", 1, "h", 1, "p"), (500, "X y" * 9000, "en", "alone", 1, "h", 1, "p")]
    rows += odd + [odd[1]] * 2
    rng.shuffle(rows)
    return rows


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_manifest(rows):
    def leaf(r, text):
        return H(*map(field, (r[0], r[3], r[2], r[4], text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: levels([leaf(r, r[1]) for r in groups[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    found = collections.Counter()
    for at, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            path = []
            for tree, place in ((trees[s], i), (top, at)):
                for level in tree[:-1]:
                    run = place // 16 * 16
                    path.append(("".join(level[run:place]), "".join(level[place + 1 : run + 16])))
                    place //= 16
            own = h = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                h = leaf(r, "".join(c.lower() if c in string.ascii_uppercase else c for c in r[1]))
            for before, after in path:
                h = H(before, h, after)
            proof = H(*[a + b for a, b in path])
            found[r[0], own, trees[s][-1][0], top[-1][0], proof, h] += 1
    return found


@pytest.mark.parametrize("n,levels", [(0, 3), (120, 3), (700, 1), (1500, 2)])
def test_manifest(session, monkeypatch, n, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    monkeypatch.setattr(merkle, "LEAVES_A_TASK", 100)
    rows = manifest_rows(n, n)
    docs = session.createDataFrame(rows, SCHEMA)
    tampered = F.when(F.crc32(docs.doc_id.cast("string")) % 5 == 0, merkle.lower_cased(docs.text))
    proved = merkle.prove(merkle.leaves(docs, tampered))
    folded = merkle.fold(F.coalesce("claim", "leaf"), F.col("path"))
    got = proved.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), folded).collect()
    assert collections.Counter(map(tuple, got)) == brute_manifest(rows)


def test_manifest_of_nothing_and_of_one_row(session):
    assert merkle.prove(merkle.leaves(session.createDataFrame([], SCHEMA))).count() == 0
    [one] = merkle.prove(merkle.leaves(session.createDataFrame([(1, "x", None, None, 2, "", 0, "")], SCHEMA))).collect()
    assert one.leaf == one.subroot == one.root and one.path == [] and one.claim is None


# ---- prefix trie -------------------------------------------------------------


def conversation_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-5, n), *range(10**9, 10**9 + 25)]:
        if c % 40 == 0 or rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 5, 12])):
            rows.append((c, t if t else rng.choice([None, 0]), rng.choice(["user", None]), rng.choice(["hi there", "a\tb  c", "", None, "ä"]), 1, "x"))
    rows += [(7, t, "user", f"turn {t % 3}", 1, "x") for t in range(20, 60)] + [(None, 1, "user", "lost", 1, "x")]
    rows += [(c, t, "user", "same words again", 1, "x") for c in range(2000, 2060) for t in range(3)]
    rng.shuffle(rows)
    return rows


def brute_trie(rows):
    turns = collections.defaultdict(list)
    for c, number, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = f"{len(role.encode())}:{role}{text}"
            key = (number is not None, number or 0, hashlib.sha256(said.encode()).digest()[:16])
            turns[c].append((key, (role, text)))
    own = {c: [x for _, x in sorted(t, key=lambda x: x[0])] for c, t in turns.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        first = c - int(math.fmod(c, 20))
        path = tuple(own.get(first, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, inside in members.items():
        words = len(p[-1][1].replace("\x0b", " ").split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(inside) - 1) * words
    return collections.Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], H(",".join(map(str, ends[p]))))
        for p, m in members.items()
    )


@pytest.mark.parametrize("shard,segment,hot", [(1024, 256, 10_000), (8, 4, 2)])
def test_prefix_trie(session, monkeypatch, shard, segment, hot):
    rows = conversation_rows(shard, 120)
    monkeypatch.setattr(prefix_trie, "HOT_CHILDREN", hot)
    conversations = session.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, hi string")
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(conversations), shard, segment).drop("hi", "lo").collect()
    assert collections.Counter(map(tuple, got)) == brute_trie(rows)


def test_no_conversations(session):
    none = session.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(none)).count() == 0


# ---- languages ---------------------------------------------------------------


def brute_sum(word, share):
    if not word:
        return 1.0
    return sum(share[p] * brute_sum(word[len(p) :], share) for p in share if word.startswith(p))


def test_the_forward_sum_is_over_all_segmentations():
    pieces = [bytes([b]) for b in b" abc\xc3\xa9"] + [b" a", b"ab", b"bca", b"abcabcabc", b"cabcabcabca", b"\xc3\xa9"]
    rng = np.random.default_rng(1)
    shares = rng.dirichlet(np.ones(len(pieces)), 3).T
    model = langid.Model(pieces, ["x", "y", "z"], shares, np.zeros(3))
    texts = [b" a", b" abcabcabcabc", " éabé".encode(), b" cab", b" bbb", b" cabcabcabcabc"]
    got = np.exp(langid.Segmenter(pieces).logs_of(texts, langid.weights_of(model)))
    wanted = [[brute_sum(t, dict(zip(pieces, shares[:, k], strict=True))) for k in range(3)] for t in texts]
    assert np.allclose(got, wanted, rtol=1e-9)


def test_expected_uses_add_up_to_the_bytes():
    pieces = [bytes([b]) for b in b" abc"] + [b" a", b"abc", b"bca"]
    model = langid.Model(pieces, ["x"], np.full((len(pieces), 1), 1 / len(pieces)), np.zeros(1))
    out = np.zeros((len(pieces), 1))
    for _, lattice in langid.Segmenter(pieces).lattices([b" abca", b" bc"]):
        lattice.expected(langid.weights_of(model), np.full((1, 1), 2.0), out)
    assert sum(len(p) * n for p, n in zip(pieces, out[:, 0], strict=True)) == pytest.approx(2 * (5 + 3))


def test_words_hold_every_letter():
    token = ("ß" * 45 + "x").encode()
    assert b"".join(x[1:] for x in langid.words_of(token)) == token and all(len(x) <= 81 for x in langid.words_of(token))
    assert langid.tokens_of("Ab1cD—é!") == ["ab".encode(), "cd—é".encode()] and langid.words_of("cd—é".encode()) == [b" cd", " é".encode()]


def test_language_identification(session):
    rng = random.Random(4)
    sounds = {"aa": "lomi ranu teka".split(), "bb": "schtru gromp zwelk".split(), "cc": "über süß größe".split()}
    rows = []
    for i in range(240):
        lang = rng.choice(list(sounds))
        text = " ".join("".join(rng.choice(sounds[lang])[: rng.randint(2, 6)] for _ in range(2)) for _ in range(rng.randint(3, 40)))
        rows.append((i, text, lang if i % 9 else None, lang, 0.5))
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !?", "aa"), (903, "lomi " * 20000, None), (904, "x" * 50000, None), (None, rows[0][1], None)]
    docs = session.createDataFrame([r[:3] + r[4:] for r in rows] + [(*r, 0.5) for r in odd * 2], "doc_id long, text string, lang string, score double")
    pieces = langid.read_pieces(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))), pieces)
    assert model.languages == ["aa", "bb", "cc"] and np.allclose(model.shares.sum(axis=0), 1)
    found = langid.identify(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = collections.defaultdict(set)
    for r in found.collect():
        got[r.doc_id].add((r.lang_pred, r.score))
        assert 0 <= r.score <= 1
    assert all(len(x) == 1 for x in got.values())
    assert all(got[d] == {("und", 0.0)} for d in (900, 901, 902)) and {x for x, _ in got[903]} == {"aa"}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert held and all({x for x, _ in got[r[0]]} == {r[3]} for r in held)
    none = langid.learn(docs.where("false"), pieces)
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, none).collect()} == {("und", 0.0)}
    assert langid.identify(docs.where("false"), model).count() == 0


# ---- identity of words ---------------------------------------------------------


def thue_morse(size):
    a, b = b"a", b"b"
    while len(a) < size:
        a, b = a + b, b + a
    return a.decode(), b.decode()


@pytest.mark.parametrize("size", [256, 1024, 4096])
def test_words_that_break_polynomials_are_told_apart(session, size):
    a, b = thue_morse(size)
    words = w.words_of(np.frombuffer(f"{a} {b}".encode(), np.uint8), np.array([0, 2 * size + 1]), two=True)
    assert words.hash[0] != words.hash[1] and words.second[0] != words.second[1]
    docs = session.createDataFrame([(1, " ".join([a] * 20)), (2, " ".join([b] * 20)), (10, a)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated(docs).collect()} == {1: 0, 2: 0, 10: 0}
    assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()} == {1: 1, 2: 2, 10: 10}


def test_colliding_hashes_do_not_make_equal_words():
    text = b"aaaa bbbb aaaa cccc bbbb " + b"x" * 2000 + b" " + b"y" * 2000
    words = w.words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]), two=True)
    words.hash[:], words.second[:] = 1, 2
    ids = w.exact_ids(words).tolist()
    assert ids[0] == ids[2] and ids[1] == ids[4] and len(set(ids)) == 5
    line = " ".join(["p q r s t u v w x y"] * 4 + ["p q r s t u v w x z"] * 2)
    data = np.frombuffer(line.encode(), np.uint8)
    words = w.words_of(data, np.array([0, len(data)]), two=True)
    at = np.arange(len(words.hash) - 19)
    wanted = substring_dedup._later(words, at)
    words.hash[:], words.second[:] = 1, 2
    assert wanted.any() and not wanted.all() and np.array_equal(substring_dedup._later(words, at), wanted)


def test_unseen_words_are_not_known(session):
    a, b = thue_morse(1024)
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = session.createDataFrame([(1, a), (ids[0] if ids[0] != 1 else ids[1], b)], "doc_id long, text string")
    got = {r.doc_id: r.n_known for r in lm.log_probabilities(docs).collect()}
    assert sorted(got.values()) == [1, 2]  # the end alone, and the end with the word


def test_equal_counts_fill_the_table(session):
    counts = session.range(500).selectExpr("xxhash64(id) AS h", "xxhash64(id, 1) AS s", "1L AS c")
    table = lm.frequent_table(counts, 100)
    assert 60 <= len(table.hashes) <= 100 and sorted(table.rank) == list(range(len(table.hashes)))


def test_a_hot_minimiser_is_split(session, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(2000)]
    texts = []
    for i in range(80):
        text = [rng.choice(words) for _ in range(60)]
        text[30:30] = ["aa", "bb", "cc", "dd"]
        if i % 8 == 7:
            text[5:5] = texts[i - 3].split()[10:45]
        texts.append(" ".join(text))
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    plain = sorted(map(tuple, substring_dedup.remove_repeated(docs).collect()))
    deal = substring_dedup.deal
    for limit in (20, 150):
        monkeypatch.setattr(substring_dedup, "deal", lambda keyed, buckets, limit=limit: deal(keyed, buckets, limit))
        assert len(deal(docs.selectExpr("doc_id AS key", "text"), 8, limit).hot) > 0
        assert sorted(map(tuple, substring_dedup.remove_repeated(docs).collect())) == plain
    assert sum(r[2] for r in plain) >= 10 * 34


# ---- permutations, recall, caches ----------------------------------------------


@pytest.mark.parametrize("letters,size", [(string.ascii_lowercase, 2), (string.ascii_lowercase, 3), (string.ascii_letters + string.digits, 2), ("0123456789abcdefABCDEF", 3)])
def test_every_string_of_a_format_has_its_own_pseudonym(session, letters, size):
    values = ["".join(x) for x in itertools.product(letters, repeat=size)]
    frame = session.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in frame.select(pii.permuted_text(F.col("v"), "key", F.lit("x"))).collect()]
    assert len(set(got)) == len(values)
    assert all([c.isdigit() for c in x] == [c.isdigit() for c in y] for x, y in zip(got, values, strict=True))


def test_recall_of_planted_vectors(session):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 64))
    noise = rng.normal(size=(300, 64))
    own = base[:300] / np.linalg.norm(base[:300], axis=1, keepdims=True)
    noise -= (noise * own).sum(axis=1, keepdims=True) * own
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cosine = rng.uniform(0.9505, 0.97, size=(300, 1))
    near = cosine * own + np.sqrt(1 - cosine**2) * noise
    vectors = np.concatenate([base, near])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    frame = session.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in ed.near_duplicate_vectors(frame).collect()}
    assert all(got[i] <= n for i, n in enumerate(links.tolist()))
    assert sum(got.values()) >= 0.95 * links.sum() > 500


@pytest.mark.parametrize("spread", [0.02, 0.06, 0.1, 0.14])
@pytest.mark.parametrize("single", [True, False])
def test_links_by_balls(session, monkeypatch, spread, single):
    """Balls that link as a whole, not at all, or in part; every count is that of all pairs."""
    monkeypatch.setattr(ed, "BLOCK", 20)
    monkeypatch.setattr(ed, "TILE", 3)
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((3, 12))
    centres[1] = centres[0] + 0.25 * rng.standard_normal(12)
    vectors = np.concatenate([c + spread * rng.standard_normal((150, 12)) for c in centres] + [rng.standard_normal((5, 12))])
    vectors = vectors.astype(np.float32 if single else np.float64)
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    copies = rng.integers(1, 4, len(unit))
    of = [0] * 300 + [1] * 150 + [2] * 5
    linked = unit @ unit.T >= 0.95
    same_component = np.array(of)[:, None] == np.array(of)[None, :]
    expected = (linked & same_component & ~np.eye(len(unit), dtype=bool)) @ copies
    stored = vectors if single else unit
    rows = [(i, 12, int(m), bytearray(stored[i].tobytes()), of[i]) for i, m in enumerate(copies)]
    frame = session.createDataFrame(rows, "key long, dim int, m long, vector binary, component long")
    got = {r.key: r.n for r in ed.link_counts(frame).collect()}
    assert [got[i] for i in range(len(unit))] == expected.tolist()
    met = ed.ball_meetings(ed.in_balls(frame).where("blocks > 1"))
    compared, blocks = met.where("other IS NOT NULL").count(), met.select("component", "block").distinct().count()
    assert blocks <= 2 * (15 + 8)
    assert compared < 0.5 * blocks**2 / 2 if spread < 0.05 else compared > 0


def test_one_tight_group_compares_no_vectors(session, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 50)
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal(32) + 0.05 * rng.standard_normal((2000, 32))
    rows = [(i, 32, 1, bytearray((v / np.linalg.norm(v)).tobytes()), 0) for i, v in enumerate(vectors)]
    frame = session.createDataFrame(rows, "key long, dim int, m long, vector binary, component long")
    assert ed.ball_meetings(ed.in_balls(frame)).where("other IS NOT NULL").count() == 0
    assert {r.n for r in ed.link_counts(frame).collect()} == {1999}


def test_a_worker_builds_its_counter_once(session):
    tokenizer = "".join(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    one = tc.counting_of("name", tokenizer, {})
    assert tc.counting_of("name", tokenizer, {}) is one and tc.counting_of("other", tokenizer, {}) is not one


def test_shingles_of_one_class_are_unique_among_the_classes(session):
    """Shingles whose other texts did not survive are not sent on, nor classes that have too few others."""
    sets = {1: range(1, 11), 2: [*range(1, 10), 11], 3: range(20, 30), 4: [1, *range(50, 59)]}
    rows = [(k, 10, 10, bytearray(np.array(sorted(x), np.uint64).tobytes())) for k, x in sets.items()]
    classes = session.createDataFrame(rows, "key long, n long, r long, tokens binary")
    got = ngram_join.ranked_classes(classes, 4).collect()
    assert {r.key: (r.n, r.r, np.frombuffer(r.tokens, np.uint64).tolist()) for r in got} == {
        k: (10, 9, list(range(1, 10))) for k in (1, 2)
    }
    assert all(len(r.ranks) == 9 and min(r.ranks) > 0 for r in got)

"""Collocations, whole packing and the Merkle manifest against plain Python, with odd rows."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from panelweave.llm import byte_pairs, collocations, merkle, min_slack  # noqa: E402
from panelweave.llm.queries import QUERIES, tokenizer  # noqa: E402
from panelweave.llm.workers import ship  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, tree string, at int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Missing values, empty and very long texts, repeated rows and clashing columns.
ODD = [
    (None, "Only here.\nTwice.", None, None, None, "x", "t", 1), (None, None, None, None, None, "x", "t", 1),
    (5, "", "en", "a", 0, "x", "t", 1), (5, "", "en", "a", 0, "x", "t", 1), (6, " \n\t ", "en", "", 4, None, None, None),
    (7, "x" * 50_000 + " " + "la " * 3000, "de", "a", 59_001, "x", "t", 1),
    (8, "café \U0001f600 it's　so <|endoftext|> \n\n<|endoftext|>", None, "é", 3, "x", "t", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark, odd):
    return spark.createDataFrame([], SCHEMA)


# Collocations


def plain_collocations(rows, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for size in range(1, 5):
                counts[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        hidden = {
            g[i : i + size]
            for g, longer in often.items() for size in range(2, len(g)) for i in range(len(g) - size + 1)
            if 100 * longer >= 80 * f[g[i : i + size]]
        }
        found = []
        for g, a in often.items():
            score, _, l, r = min(
                (2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))
            )
            if g not in hidden:
                found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -s))
    return out


def test_collocations(spark, odd, none):
    rng = random.Random(3)
    known = [f"w{k}" for k in range(12)] + ["Café", "été", "a"]
    passage = " ".join(rng.choices(known, k=40))
    texts = []
    for i in range(60):
        noise = " ".join(rng.choices(known, k=25)) + rng.choice([".", " ", ",\n", "\t"])
        texts.append((noise + passage + "! " + "ring ring ring ring ring " * (i % 3), rng.choice(["en", "de", None])))
    texts += [("a b a b a b a b a b a b a b", "en")] * 6 + [(r[1], r[2]) for r in ODD]
    texts += [("und so", "und"), (None, "xx"), ("ONE. two", "xx")]
    frame = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    for block in (1, 1 << 20):
        found = collocations.collocations(frame, least=3, block_bytes=block)
        assert Counter(map(tuple, found.collect())) == Counter(plain_collocations(texts, 3))
    few = collocations.collocations(frame, least=3, top=2).collect()
    assert Counter(map(tuple, few)) == Counter(plain_collocations(texts, 3, 2))
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(odd, least=2).where("lang = 'de'").collect()[0].phrase == "la la la la"


def unpacked(runs):
    return [(runs.words[a:b], n) for a, b, n in zip(runs.offsets, runs.offsets[1:], runs.weight)]


def test_paths_hold_every_edge_once():
    rng = random.Random(8)
    for _ in range(50):
        words = np.array(rng.choices(range(4), k=80))
        joined = np.array([rng.random() < 0.9 for _ in words])
        joined[-1] = False
        edges = Counter(tuple(words[i : i + 4]) for i in range(77) if joined[i : i + 3].all())
        from_paths = Counter()
        for path, weight in unpacked(collocations.Graph(words, joined).paths()):
            for i in range(len(path) - 3):
                from_paths[tuple(path[i : i + 4])] += weight
        assert from_paths == edges


def test_a_repeated_passage_is_one_path():
    words = np.tile(np.arange(30), 5)
    joined = np.tile(np.r_[np.ones(29, bool), False], 5)
    ((path, weight),) = unpacked(collocations.Graph(words, joined).paths())
    assert path.tolist() == list(range(30)) and weight == 5


def test_large_counts_are_exact(spark, odd):
    big = 9_000_000_000_000_000_000
    paths = spark.createDataFrame(
        [("en", ["a", "b", "c", "d"], big // 3, True), ("en", ["d"], big // 3, False), ("en", ["c", "d"], big // 3, False),
         ("en", ["b", "c", "d"], big // 3, False)],
        collocations.PATHS,
    )
    four, three, two, one = (c.collect() for c in collocations.graph_counts(paths))
    assert [r.n for r in four] == [big // 3] and {r.w1: r.n for r in three} == {"a": big // 3, "b": big // 3}
    assert {r.w1: r.n for r in one} == {w: big // 3 for w in "abcd"} and len(two) == 3


# Packing whole documents


def check_packing(texts, pieces, capacity):
    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    expected, total = Counter(), 0
    for doc_id, text in texts:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter(tuple(p)[:5] for p in pieces) == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-total // capacity)


@pytest.mark.parametrize("folder, more", [(FOLDER, 1), ("/root/testdata/sf0.01", 0)])
def test_best_fit_query(spark, odd, folder, more):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    used, least = check_packing(map(tuple, rows), QUERIES["op12_best_fit"](spark, folder).collect(), 2048)
    assert used <= least + more


def test_packing_odd_rows(spark, odd, none):
    path = tokenizer("byte_bpe_50k.json")
    for capacity in (1, 16, 256):
        found = min_slack.pack_whole(odd.repartition(3), path, capacity, ids=True).drop("ids").collect()
        check_packing([r[:2] for r in ODD], found, capacity)
    ids = min_slack.pack_whole(odd, path, ids=True).select("ids", "ids_crc32").collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in ids)
    assert min_slack.pack_whole(none, path).count() == 0
    with pytest.raises(ValueError):
        min_slack.pack_whole(odd, path, 1 << 15)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5), st.integers(12, 30))
def test_fullest_is_the_best_of_all_combinations(counts, capacity):
    best = max(
        total for times in product(*(range(n + 1) for n in counts.values()))
        if (total := sum(length * t for length, t in zip(counts, times, strict=True))) <= capacity
    )
    found = min_slack.fullest(counts, capacity)
    assert sum(length * t for length, t in found) == best and all(0 < t <= counts[length] for length, t in found)
    held = min_slack.sequence_of(counts, capacity)
    longest = max(counts)
    rest = {**counts, longest: counts[longest] - 1}
    most = max(
        total for times in product(*(range(n + 1) for n in rest.values()))
        if (total := longest + sum(length * t for length, t in zip(rest, times, strict=True))) <= capacity
    )
    assert sum(length * t for length, t in held) == most and dict(held)[longest]
    assert all(0 < t <= counts[length] for length, t in held)
    entries = min_slack.plan(counts, capacity)
    last = {}
    for length, first, times, sequence, _ in entries.tolist():
        following = [s for *_, s, _ in entries.tolist() if s > sequence]
        repeats = (min(following) if following else None)
        assert first == last.get(length, 0)
        if repeats is not None:
            last[length] = first + times * (repeats - sequence)


def test_fast_ids_are_the_library_s():
    path = tokenizer("byte_bpe_50k.json")
    plain, fast = Tokenizer.from_file(path), byte_pairs.byte_encoder(path)
    assert fast.ranked is not None
    rng = random.Random(11)
    signs = list("aZéß1²٠ '\n\t\r.,x-_　中́​\u0085 \U0001f600") + ["'s", "'ll", "<|endoftext|>", "  "]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += [" " * 600_000 + "a", "ab" * 100_000, "\n" * 50_000]
    for text in texts:
        assert fast(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert byte_pairs.ByteEncoder(tokenizer("word_bpe_49k.json")).ranked is None


# Merkle manifest


def plain_manifest(rows):
    def h(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
        return out

    def climb(tree, at, digest):
        beside = []
        for nodes in tree[:-1]:
            first = at - at % 3
            run = nodes[first : first + 3]
            beside += [x for k, x in enumerate(run) if first + k != at]
            run[at - first] = digest
            digest, at = h(run), at // 3
        return beside, digest

    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        fields = [doc_id, source, lang, n_chars]
        leaf = h([*map(field, fields), field(text)])
        changed = text
        if text is not None and zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 2 == 0:
            changed = text.replace("\n", "")
        order = (doc_id is not None, doc_id or 0, leaf)
        groups[source].append((order, doc_id, leaf, h([*map(field, fields), field(changed)])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf for _, _, leaf, _ in sorted(groups[s])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for at, (_, doc_id, leaf, altered) in enumerate(sorted(groups[s])):
            low, folded = climb(trees[s], at, altered)
            high, folded = climb(top, k, folded)
            root = top[-1][0]
            out[(doc_id, leaf, trees[s][-1][0], root, h(low + high), folded, folded == root)] += 1
    return out


def test_manifest(spark, odd, none):
    rng = random.Random(2)
    many = [
        (i, "a\nb" * rng.randint(0, 2) or None, "en", rng.choice(["hot"] * 9 + [f"s{i % 40}", None]), i, "x", "t", 1)
        for i in range(2300)
    ]
    rng.shuffle(many)
    for rows in (many, ODD, ODD[:1], [r for r in many if r[3] == "hot"][:730], many[:1] * 5):
        frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert Counter(map(tuple, merkle.manifest(frame, FIELDS).collect())) == plain_manifest(rows)
    assert merkle.manifest(none, FIELDS).count() == 0


def test_folding_resumes_the_state_before_the_slot():
    rng = random.Random(4)
    for n in (1, 2, 3, 4, 10, 28, 100):
        leaves = [hashlib.sha256(bytes([rng.randrange(256)] * 9)).hexdigest() for _ in range(n)]
        tree = merkle.Tree(leaves, merkle.levels_of(n))
        for at in range(n):
            new = hashlib.sha256(b"new%d" % at).hexdigest()
            changed = merkle.Tree([*leaves[:at], new, *leaves[at + 1 :]], merkle.levels_of(n))
            assert tree.fold(at, new) == changed.top and tree.fold(at, leaves[at]) == tree.top
            steps = [{"left": a, "right": b} for a, b in tree.siblings(at)]
            assert merkle.Way(steps).fold(new) == changed.top


def test_every_leaf_is_folded_and_compared_with_the_root_that_was_built(monkeypatch):
    leaves = [hashlib.sha256(bytes([k])).hexdigest() for k in range(5)]
    tree, new = merkle.Tree(leaves, merkle.levels_of(5)), hashlib.sha256(b"new").hexdigest()
    table = pa.table({
        "tree": ["=a"] * 5, "doc_id": list(range(5)), "digest": leaves, "at": list(range(5)), "n": [5] * 5,
        "altered": pa.array([None, new, None, None, None], pa.string()),
    })
    folded, fold = [], merkle.Tree.fold
    monkeypatch.setattr(merkle.Tree, "fold", lambda self, at, digest: folded.append(at) or fold(self, at, digest))
    for root in (tree.top, "another"):
        ways = pa.Table.from_pylist(
            [{"tree": "=a", "at": 0, "steps": [], "subroot": tree.top, "root": root}], schema=merkle._WAY
        )
        found = merkle._prove(table, ways).to_pylist()
        assert folded == [0, 1, 2, 3, 4] and {r["root"] for r in found} == {root}
        assert [r["folded_root"] == tree.top for r in found] == [True, False, True, True, True]
        assert [r["verified"] for r in found] == [k != 1 and root == tree.top for k in range(5)]
        folded.clear()

"""Queries on the smallest given tables, and the pipeline, against plain Python."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
import tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from panelweave.llm import packing  # noqa: E402
from panelweave.llm.queries import ORACLE, QUERIES, tokenizer  # noqa: E402
from panelweave.llm.workers import releasing  # noqa: E402
from panelweave.sources.scratch import materialize  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingle_counts(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def near_classes(texts):
    """Smallest id of each component of pairs at a weighted similarity of 0.8 or more."""
    counts = {i: shingle_counts(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i in sorted(counts):
        for shingle in counts[i]:
            holders[shingle].append(i)
    pairs = {(a, b) for h in holders.values() for k, b in enumerate(h) for a in h[:k]}
    for a, b in pairs:
        shared = sum((counts[a] & counts[b]).values())
        total = sum((counts[a] | counts[b]).values())
        if 10 * shared >= 8 * total:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in texts}


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def test_near_classes(spark, texts):
    found = QUERIES["op8_minhash_dedup"](spark, FOLDER).collect()
    expected = near_classes({i: r.text for i, r in texts.items()})
    assert {r.doc_id: r.class_id for r in found} == expected
    assert {r.doc_id for r in found if r.kept} == set(expected.values())
    assert len(set(expected.values())) < len(expected)


def test_sure_secrets(spark):
    folder = "/root/testdata/sf0.01"  # the smallest folder has none
    texts = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    patterns = {
        "assign": r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
    }
    least = {"assign": 6, "access": 20, "hex": 24}
    some = 0
    for r in QUERIES["op6_secret_scans"](spark, folder).collect():
        spans = [
            (m.start(), order, f"{kind}:{m.start()}:{m.end()}", kind)
            for order, (kind, pattern) in enumerate(patterns.items())
            for m in re.finditer(pattern, texts[r.doc_id].text or "")
            if len(m[2] if kind == "assign" else m[0]) >= least[kind]
        ]
        base = [s[2] for s in sorted(spans)]
        kinds = Counter(s[3] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in patterns)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))
        some += bool(base)
    assert some


def test_quality_counts(spark, texts):
    for r in QUERIES["op10_quality_rules"](spark, FOLDER).collect():
        text = texts[r.doc_id].text or ""
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        eights = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        often = Counter(eights)
        again = {i + k for i, x in enumerate(eights) if often[x] > 1 for k in range(8)}
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(again)
        assert r.base_failed == (len(w) < 20 or 100 * len(again) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_languages_held_out(spark, texts):
    found = QUERIES["op3_language_id"](spark, FOLDER).collect()
    judged = [r for r in found if r.held_out and texts[r.doc_id].lang and r.lang_pred != "und"]
    right = sum(r.lang_pred == texts[r.doc_id].lang for r in judged)
    assert len(judged) > 20 and right >= 0.9 * len(judged)


def test_language_model(spark, texts):
    def held_out(i):
        return zlib.crc32(str(i).encode()) % 10 == 0

    counts, n = Counter(), 0
    for i, r in texts.items():
        if not held_out(i):
            counts.update([*words(r.text), None])
    n = sum(counts.values())
    model = plain = 0.0
    for r in QUERIES["op2_lm_scoring"](spark, FOLDER).collect():
        w = [*words(texts[r.doc_id].text), None]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (len(counts) + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in counts for x in w), n)
        assert r.held_out == held_out(r.doc_id)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-6)
        if r.held_out:
            model, plain = model + r.score, plain + base
    assert model > plain


def test_passages_of_fifty_words(spark, texts):
    found = QUERIES["op5_substring_dedup"](spark, FOLDER).collect()
    places = defaultdict(list)
    for i in sorted(texts):
        w = words(texts[i].text)
        for k in range(len(w) - 49):
            places[tuple(w[k : k + 50])].append(i)
    later = {i for p in places.values() for i in p[1:] if i != p[0]}
    assert later and later <= {r.doc_id for r in found if not r.kept}
    short = Counter()
    for i in texts:
        w = words(texts[i].text)
        short.update(tuple(w[k : k + 25]) for k in range(len(w) - 24))
    for r in found:
        if r.kind == "passage":
            w = words(texts[r.doc_id].text[r.start : r.start + r.length])
            assert len(w) >= 25 and short[tuple(w[:25])] > 1


def test_pipeline(spark, tmp_path):
    rng = random.Random(5)
    vocabulary = {
        "en": "the house river under light with stone garden winter and morning water because always people",
        "de": "der haus fluss unter licht mit stein garten und morgen wasser weil immer leute zwischen durch",
    }
    rows = []
    for lang, known in vocabulary.items():
        for _ in range(60):
            rows.append((len(rows), " ".join(rng.choices(known.split(), k=60)), lang))
    first = rows[3][1]
    key = "AKIA" + "Q7" * 8
    rows += [
        (200, first.upper(), "en"), (201, first + " ending", "en"), (202, "12 345", None),
        (203, None, "en"), (204, "", "de"), (205, rows[70][1] + f" {key} token=abcdef99", "de"),
        (206, f"the people and the water under the house, {key}", "en"),
    ]
    frame = spark.createDataFrame([(*r, "digest") for r in rows], "doc_id long, text string, lang string, digest string")
    frame.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {"documents": {r.doc_id: r.text for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == frame.columns
        docs = materialize(out, f"test-{name}")
        kept[name] = {r.doc_id: r.text for r in docs.collect()}

    spoken = kept["language_id"]
    assert not {202, 203, 204} & set(spoken) and len(spoken) >= 0.95 * 120
    last = {t.translate(UPPER): i for i, t in sorted(spoken.items())}
    assert set(kept["exact_dedup"]) == set(last.values()) and 3 not in last.values()
    assert set(kept["near_dedup"]) == set(near_classes(kept["exact_dedup"]).values())
    assert 201 not in kept["near_dedup"] and 205 not in kept["near_dedup"]
    assert kept["secret_scans"] == {i: t.replace(key, "[secret]") for i, t in kept["near_dedup"].items()}

    plain, held = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), Counter()
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    for p in pieces:
        held[p.doc_id] += p.length
    assert held == {
        i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept["secret_scans"].items()
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS FROM '{FOLDER}/{table}.parquet'")
    expected = con.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(expected.fetchall())


def test_packing_holds_one_vocabulary_and_rows_leave_with_their_chunk(monkeypatch):
    path, loaded, load = tokenizer("word_bpe_49k.json"), [], Tokenizer.from_file
    holder = type("Tokenizer", (), {
        "from_file": staticmethod(lambda p: loaded.append(p) or load(p)), "__new__": lambda cls, model: Tokenizer(model),
    })
    monkeypatch.setattr(tokenizers, "Tokenizer", holder)
    packing.UnitEncoder(path)
    assert loaded == [path]
    monkeypatch.undo()

    class Task:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": staticmethod(lambda: Task)}))
    texts = ["word " * 3000] * 400  # 6 MB, in chunks of 1 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], names=["doc_id", "text"])
    given = list(packing._pack_task(path, 2048, 16)(iter([batch])))
    assert len(given) > 5 and max(b.num_rows for b in given[:-1]) < 300


def test_a_worker_drops_what_another_operator_remembers():
    path = tokenizer("word_bpe_49k.json")
    encoder = packing.unit_encoder(path)
    list(releasing(lambda batches: batches, packing.unit_encoder)(iter([])))
    assert packing.unit_encoder(path) is encoder
    list(releasing(lambda batches: batches)(iter([])))
    assert packing.unit_encoder.cache_info().currsize == 0

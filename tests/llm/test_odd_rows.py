"""The tokenizing queries on a whole given table, and odd rows for every operator and stage."""

import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import hashlib  # noqa: E402

import corpus_pipeline  # noqa: E402
from panelweave.llm import language_id, secret_scans, substring_dedup, url_filters  # noqa: E402
from panelweave.llm.queries import QUERIES, tokenizer  # noqa: E402
from panelweave.llm.workers import ship  # noqa: E402
from panelweave.sources.scratch import materialize  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TEXT = "the people and the water under the house with a light stone in the garden"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _metadata string, row_file string"


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, len(text or ""), "meta", "file")


@pytest.fixture(scope="module")
def texts(spark):
    ship(spark)
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def test_packing_query(spark, texts):
    plain = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    ids = {i: [*plain.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    held, sequences = defaultdict(list), defaultdict(list)
    for p in QUERIES["op1_packing"](spark, FOLDER).collect():
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert len(own) == p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        held[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert set(held) == set(ids)
    for parts, size in [(held[i], len(x)) for i, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == size if size else at == 2048 or at & (at - 1) == 0


def test_bpe_query(spark, texts):
    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    expected = set()
    for i, t in texts.items():
        ids = plain.encode(t, add_special_tokens=False).ids
        back = plain.decode(ids, skip_special_tokens=False)
        expected.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                      hashlib.sha256(back.encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op7_bpe"](spark, FOLDER).collect()} == expected


def test_language_of_long_and_repeated_texts(spark, texts):
    rows = [row(i, f"{TEXT} {i}") for i in range(40)] + [row(100 + i, f"das haus und der fluss {i} sind weit", "de") for i in range(40)]
    rows += [row(7, f"{TEXT} 7")] * 3 + [row(500, f"{TEXT} " * 4000), row(None, TEXT, None), row(None, None, None)]
    found = language_id.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    assert {r.lang_pred for r in found if r.doc_id in (7, 500)} == {"en"}
    assert Counter(r.lang_pred for r in found if r.doc_id is None) == {"en": 1, "und": 1}


def test_urls_odd_rows(spark, texts):
    pages = spark.createDataFrame(
        [(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None), (2, ""), (3, "http://a.org/" + "x/" * 20_000), (4, "://"),
         (5, "HTTP://A.ORG")], "page_id long, url string",
    )
    rules = spark.createDataFrame([("a.org", "/x", "block"), (None, "/", "block")], "host string, path string, verdict string")
    found = Counter((r.page_id, r.host, r.rule, r.verdict) for r in url_filters.filter_urls(pages, rules).collect())
    assert found == {
        (1, "a.org", "a.org/x", "block"): 2, (None, "", None, "allow"): 1, (2, "", None, "allow"): 1,
        (3, "a.org", "a.org/x", "block"): 1, (4, "", None, "allow"): 1, (5, "a.org", None, "allow"): 1,
    }
    assert {r.verdict for r in url_filters.filter_urls(pages, rules.where("false")).collect()} == {"allow"}
    assert url_filters.filter_urls(pages.where("false"), rules).count() == 0


def test_secrets_odd_rows(spark, texts):
    key = "AKIA" + "Q7" * 8
    long = "word " * 20_000 + key + " word" * 20_000 + " aB3" + "aB3" * 9
    rows = [row(1, f"x {key}")] * 3 + [row(2, long), row(None, None), row(3, "")]
    found = secret_scans.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.n_access for r in found if r.doc_id == 1] == [1, 1, 1]
    (far,) = [r for r in found if r.doc_id == 2]
    assert far.links.endswith("@line") and far.spans.count(",") == 1
    assert all(not r.spans and not r.links for r in found if r.doc_id in (3, None))


def test_stages_on_odd_tables(spark, texts, tmp_path):
    key = "AKIA" + "Q7" * 8
    rows = [row(i, f"{TEXT} {i} and number {i * 7} of them") for i in range(30)]
    rows += [row(i, f"das haus und der fluss {i} sind weit von {i * 3} leuten", "de") for i in range(100, 130)]
    rows += [row(7, rows[7][1])] * 2  # repeated rows share an id
    rows += [row(300, f"{TEXT} {key}"), row(None, None, None), row(None, "", None), row(301, f"{TEXT}\n" * 3000), row(302, "12 345")]
    for name, given in (("odd", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(given, SCHEMA).coalesce(1).write.parquet(f"{folder}/documents.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        columns = docs.columns
        for stage, function in corpus_pipeline.STAGES[:-1]:
            docs = materialize(function(spark, docs, folder), f"odd-{stage}")
            assert docs.columns == columns
        ids = Counter(r.doc_id for r in docs.collect())
        pieces = corpus_pipeline.run(spark, folder).collect()
        assert {p.doc_id for p in pieces} == set(ids)
        if name == "odd":
            assert ids[7] == ids[301] == 1 and not {None, 302} & set(ids)
            assert {r.doc_id: r.text for r in docs.collect()}[300] == f"{TEXT} [secret]"
            assert {r._metadata for r in docs.select("_metadata").collect()} == {"meta"}


def test_passages_of_odd_rows(spark, texts):
    run = " ".join(f"shared{k}" for k in range(60))
    rows = [row(None, run), row(4, f"own {run}"), row(4, f"own {run}"), row(5, None), row(6, "")]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in found} == {None, 4} and any(r.kept for r in found)

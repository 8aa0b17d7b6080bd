"""The registered queries over whole test tables: against their SQL, or against brute force."""

import hashlib
import math
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import TABLES, assert_same
from tabularium.llm.queries import LLM_ORACLES, LLM_QUERIES
from test_decontamination import brute_force as benchmark_hits
from test_mixing import base_scores
from tokenizers import Tokenizer

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def table(name):
    assert name in TABLES
    return duckdb.sql(f"select * from '{SF_DIR}/{name}.parquet'").df().to_dict("records")


def rows(spark, name):
    return {r.doc_id: r for r in LLM_QUERIES[name](spark, SF_DIR).collect()}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def documents():
    return table("documents")


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in LLM_QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_query_agrees_with_sql(spark, name):
    assert assert_same(LLM_QUERIES[name](spark, SF_DIR), SF_DIR, LLM_ORACLES[name]) > 0


def test_languages_of_held_out_documents(spark, documents):
    found = rows(spark, "op1_language")
    assert found.keys() == {d["doc_id"] for d in documents}
    held = [d for d in documents if fold(d["doc_id"], 4) == 2]
    assert all(found[d["doc_id"]].held_out == (fold(d["doc_id"], 4) == 2) for d in documents)
    right = sum(found[d["doc_id"]].lang_pred == d["lang"] for d in held)
    assert right >= 0.97 * len(held)


def test_toxicity_of_held_out_documents(spark):
    found = rows(spark, "op5_toxicity")
    held = [(found[x["doc_id"]], x["toxic"]) for x in table("labels") if fold(x["doc_id"], 4) == 2]
    assert all(r.held_out and r.predicted == int(r.score >= 0.3) for r, _ in held)
    clean = [r.predicted for r, toxic in held if toxic == 0]
    toxic = [r.score for r, toxic in held if toxic == 1]
    assert sum(clean) <= 0.05 * len(clean)
    assert sum(s >= 0.3 for s in toxic) >= 0.5 * len(toxic)


def test_benchmark_hits(spark, documents):
    found = rows(spark, "op4_decontamination")
    items = [(x["item_id"], x["text"]) for x in table("benchmark")]
    expected = benchmark_hits([d["text"] for d in documents], items, 10)
    for doc, (hit, listed) in zip(documents, expected, strict=True):
        row = found[doc["doc_id"]]
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items) == (len(hit), sum(hit), len(listed))
        assert (row.items_sha256, row.contaminated) == (digest, any(hit))


def test_groups_of_near_copies(spark, documents):
    from test_minhash import groups, shingles

    found = rows(spark, "op6_minhash")
    sets = {d["doc_id"]: shingles(d["text"]) for d in documents}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for i, group in groups(linked, sets).items():
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (len(sets[i]), group, group == i)


def test_scores(spark, documents):
    found = rows(spark, "op7_mixing")
    learn = [fold(d["doc_id"], 7) != 2 for d in documents]
    held = [0.0, 0.0]
    for doc, use, (tokens, known, total, base) in zip(
        documents, learn, base_scores([d["text"] for d in documents], learn), strict=True
    ):
        row = found[doc["doc_id"]]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (not use, tokens, known, total)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        if not use:
            held = [held[0] + row.base_score, held[1] + row.score]
    assert held[1] > held[0]


def test_tokens(spark, documents):
    found = rows(spark, "op10_bpe")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc in documents:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        row = found[doc["doc_id"]]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_repeats_are_flagged_with_their_origin(spark, documents):
    found = rows(spark, "op9_sentences")
    by_text = {}
    for doc in sorted(documents, key=lambda d: d["doc_id"]):
        first = by_text.setdefault(doc["text"], doc["doc_id"])
        row = found[doc["doc_id"]]
        assert row.repeats == (row.n_removed > 0) == bool(row.repeats_of)
        if first != doc["doc_id"] and len((doc["text"] or "").split()) > 60:
            assert row.n_removed == row.n_sentences


def test_personal_data(spark, documents):
    from test_personal import FORMS, naive_spans

    found = rows(spark, "op13_personal")
    assert found.keys() == {d["doc_id"] for d in documents}
    for doc in documents:
        row, plain = found[doc["doc_id"]], naive_spans(doc["text"] or "")
        listed = [f"{kind}:{start}:{end}" for start, end, kind in plain]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        counts = [sum(span[2] == kind for span in plain) for kind in FORMS]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert set(listed) <= set(row.spans.split(","))

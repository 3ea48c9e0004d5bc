"""Every operator and every pipeline stage on odd rows and on empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regiostat.llm import decontamination, html_extraction, lm_scoring, mixing, near_duplicates, pii, quality_rules, secret_scan, token_counts, toxicity

SMALL = lm_scoring.Settings(block_tokens=500, bucket_tokens=20_000)


def operators(spark):
    import public_tokenizers
    bench = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (7, 1)], "doc_id long, toxic int")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "op1": lambda d: lm_scoring.lm_scores(d, F.col("doc_id") % 2 == 0, SMALL),
        "op2": lambda d: secret_scan.digest(secret_scan.scan(d)),
        "op3": mixing.mix,
        "op4": quality_rules.quality,
        "op6": lambda d: near_duplicates.near_duplicates(d, words=4),
        "op7": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "op8": lambda d: token_counts.token_counts(d, path),
        "op9": lambda d: decontamination.decontaminate(d, bench),
        "op10": lambda d: pii.digest(pii.scan(d)),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op6", "op7", "op8", "op9", "op10"])
def test_odd_rows_and_empty_table(spark, odd, none, odd_rows, name):
    op = operators(spark)[name]
    rows = op(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows)
    twice = [tuple(r) for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert op(none).collect() == []


def test_pages(spark):
    rows = [(1, "u", None, 1), (2, None, "", 2), (None, "v", "<p>", 3), (3, "w", "plain " * 40, 4), (3, "w", "plain " * 40, 4), (4, "x", "<div>" * 3000 + "deep", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    model = html_extraction.train(pages)
    got = html_extraction.extract(pages, model).collect()
    assert Counter(r["page_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(r["text"] is not None for r in got)
    assert {r["text"] for r in got if r["page_id"] in (1, 2)} == {""}
    assert html_extraction.extract(pages.limit(0), html_extraction.train(pages.limit(0))).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, 0), (2, None), (None, 1), (7, 1), (7, 0)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "zz yy"), (None, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, odd, none, folder, stage):
    f = dict(corpus_pipeline.STAGES)[stage]
    for docs in (odd, none):
        out = f(spark, docs, folder)
        assert out.columns == docs.columns
        n = out.count()
        assert n == 0 if docs is none else n > 0


def test_stage_effects(spark, tmp_path):
    from llm_helpers import as_docs, prose
    d = str(tmp_path)
    item = prose(5, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    a, live = prose(7, 300), "password=9f8e7d6c5b4a39281706"
    docs = as_docs(spark, [(1, a), (2, a), (3, a + " more words"), (4, prose(8, 50) + " " + " ".join(item.split()[3:20])), (5, prose(9, 60) + f" {live} end", "en", "s1"),
                           *[(10 + k, prose(20 + k, 60) + " password=aaaa1111bbbb2222cccc", "en", f"s{k}") for k in range(4)]])
    stages = dict(corpus_pipeline.STAGES)
    assert sorted(r.doc_id for r in stages["near duplicates"](spark, docs, d).collect()) == [1, 4, 5, 10, 11, 12, 13]
    assert 4 not in [r.doc_id for r in stages["benchmark decontamination"](spark, docs, d).collect()]
    masked = {r.doc_id: r for r in stages["secret scans"](spark, docs, d).collect()}
    assert live not in masked[5].text and "[SECRET] end" in masked[5].text and masked[5].n_chars == len(masked[5].text)
    assert all("password=aaaa1111bbbb2222cccc" in masked[10 + k].text for k in range(4))
    assert masked[1].text == a


def test_near_copies_without_ids_and_under_one_id(spark):
    a, b = prose_of(7, 300), prose_of(8, 300)
    rows = [(None, a), (None, a + " more words"), (5, b), (5, b + " other end"), (5, prose_of(9, 200)), (6, ""), (7, None), (None, ""), (8, "  "), (3, b + " third end")]
    out = dict(corpus_pipeline.STAGES)["near duplicates"](spark, as_docs_of(spark, rows), "")
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(None, a), (3, b + " third end"), (5, prose_of(9, 200)), (6, ""), (7, None), (None, ""), (8, "  ")], key=str) or \
        got == sorted([(None, a + " more words"), (3, b + " third end"), (5, prose_of(9, 200)), (6, ""), (7, None), (None, ""), (8, "  ")], key=str)


def prose_of(seed, n):
    from llm_helpers import prose
    return prose(seed, n)


def as_docs_of(spark, rows):
    from llm_helpers import as_docs
    return as_docs(spark, rows)


def test_stages_without_labels_or_benchmark(spark, odd, odd_rows, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert stages["toxicity"](spark, odd, d).count() == len(odd_rows)
    assert stages["benchmark decontamination"](spark, odd, d).count() == len(odd_rows)


def test_pipeline_run_is_its_stages_one_after_the_other(spark, tmp_path):
    from llm_helpers import as_docs, prose
    d, item, live = str(tmp_path), prose(5, 40), "password=9f8e7d6c5b4a39281706"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    clean = [(k, prose(100 + k, 80), "en", f"s{k % 2}") for k in range(40)]
    toxic = [(100 + k, prose(300 + k, 40) + " scumbag " + prose(500 + k, 40), "en", "s0") for k in range(40)]
    rows = clean + toxic + [(200, clean[0][1] + " tail", "en", "s0"), (201, prose(900, 30) + " " + item, "en", "s0"), (202, f"{prose(901, 60)} {live}", "en", "s1")]
    as_docs(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(r[0], int(100 <= r[0] < 200)) for r in rows], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    out = corpus_pipeline.run(spark, d)
    assert out.columns == as_docs(spark, rows).columns
    got = Counter(r.doc_id for r in out.collect())
    assert set(got) <= {r[0] for r in clean} | {202} and all(n <= 3 for n in got.values()) and len(got) > 20
    assert not [r for r in out.collect() if live in r.text]

"""The corpus pipeline against brute force, stage by stage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import base_text, brute_classes, brute_contamination, edited

import corpus_pipeline
from rivulet.llm import quality, suffix_index, tokens


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    items = [(i, " ".join(base_text(900 + i, 20))) for i in range(4)]
    passage = " ".join(base_text(77, 40))
    for i in range(60):
        words = base_text(i, rng.randint(40, 120))
        text = " ".join(words)
        if i % 5 == 0:
            text = " ".join(f"{w.upper()}!!" for w in words)
        if i % 7 == 1:
            text += " " + passage
        if i % 11 == 2:
            text += " " + items[i % 4][1]
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        if i % 6 == 3:
            near = " ".join(edited(text.split(), i, 1))
            rows.append((100 + i, near, "en", "copy", len(near)))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(r[0], int(not (r[1] or "").isupper()), 0) for r in rows[:60] for _ in range(2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def brute_cut(docs):
    """Texts by id with 100-byte strings that came earlier cut out in whole characters."""
    seen, out = set(), {}
    for i in sorted(docs):
        data = (docs[i] or "").encode()
        spans = []
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                spans.append({"start": p, "end": p + 100})
            seen.add(window)
        rest = suffix_index.without(
            data, suffix_index.whole_characters(data, suffix_index.merged_runs(spans, len(data)))
        ).decode()
        if rest or not data:
            out[i] = rest if docs[i] is not None else None
    return out


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    machine = quality.train_quality(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = {r.doc_id for r in quality.score_quality(docs, machine).where("predicted = 1").collect()}
    want = {i: t for i, t in texts.items() if i in scored}
    assert 0 < len(want) < len(texts)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        if number == 1:
            classes = brute_classes(want)
            want = {i: t for i, t in want.items() if classes[i] == i}
        elif number == 2:
            want = brute_cut(want)
        elif number == 3:
            report = brute_contamination(want.items(), items)
            want = {i: t for i, t in want.items() if not report[i][4]}
        if number < 4:
            assert result.columns == names
            result.write.parquet(f"{folder}/out-{name}")
            docs = spark.read.parquet(f"{folder}/out-{name}")
            assert {r.doc_id: r.text for r in docs.collect()} == want
    lengths = {r.doc_id: r.n for r in result.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    tokenizer = tokens.tokenizer(tokens.default_path())
    assert lengths == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in want.items()}
    assert result.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_applies_all_stages(spark, folder):
    packed = corpus_pipeline.run(spark, folder)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < 70
    assert np.isin(list(kept), [*range(60), *range(100, 160), 500, 501]).all()


@pytest.mark.parametrize("read", [True, False])
@pytest.mark.parametrize("shift", [0, 1 << 62])
def test_stages_treat_each_row_by_itself(spark, tmp_path, read, shift):
    item = " ".join(base_text(900, 20))
    clean = [" ".join(base_text(i, 60)) for i in range(8)]
    rows = [
        (shift + 1, clean[0]),
        (shift + 1, clean[1]),
        (shift + 2, clean[2] + " " + item),
        (shift + 2, clean[3]),
        (None, clean[4]),
        (None, clean[5] + " " + item),
        (None, clean[6]),
        (None, clean[0]),
        (None, clean[7]),
        (None, clean[7]),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    if read:
        docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    def after(stage):
        result = stage(spark, docs, str(tmp_path))
        assert result.columns == docs.columns
        return sorted((r.doc_id or 0, r.text) for r in result.collect())

    every = sorted((i or 0, t) for i, t in rows)
    assert after(corpus_pipeline.benchmark_decontamination) == [r for r in every if item not in r[1]]
    once = sorted({(i or 0, t) for i, t in rows} - {(0, clean[0])})
    assert after(corpus_pipeline.near_duplicates) == once
    cut = after(corpus_pipeline.repeats)
    assert len(cut) == len(once) and [t for _, t in cut].count(clean[0]) == 1
    assert (shift + 1, clean[0]) in cut


def test_registered():
    import __spark_entry__ as entry_point

    names = entry_point.queries().keys()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))

"""Every stage of the pipeline against a plain version, and the whole run."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from mirrorsmith.llm import mix, quality
from mirrorsmith.llm.common import stored, table
from tests.llm import test_linededup, test_neardup
from tests.llm.util import empty, frame, odd_texts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in cp.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "pack"]
    assert all(d.dtypes == stages[0].dtypes for d in stages[:-1])


def test_quality_keeps_the_good(spark, stages):
    label = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in stages[1].collect()}
    assert all((d in kept) == bool(q) for d, q in label.items())
    report = quality.quality_report(stages[0], table(spark, SF, "labels")).filter("kept").collect()
    assert kept == {r["doc_id"] for r in report}


def test_line_dedup(stages):
    before, after = stages[1].collect(), stages[2].collect()
    want = {i: t for i, _, _, t in test_linededup.brute([r["text"] for r in before], [r["doc_id"] for r in before])}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_dedup(stages):
    before = stages[2].collect()
    want = {i for i, _, c in test_neardup.brute([r["text"] for r in before], [r["doc_id"] for r in before], 5) if i == c}
    assert sorted(map(tuple, stages[3].collect())) == sorted(tuple(r) for r in before if r["doc_id"] in want)


def test_mix(stages):
    want = Counter({r["doc_id"]: r["taken"] // r["size"] for r in mix.mix_report(stages[3]).collect() if r["taken"]})
    assert Counter(r["doc_id"] for r in stages[4].collect()) == want


def test_pack(stages):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, rows = stages[4].collect(), stages[5].collect()
    length = {r["doc_id"]: len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before}
    got, size = Counter(), defaultdict(int)
    for r in rows:
        got[r["doc_id"]] += r["length"]
        size[r["sequence_id"]] += r["length"]
    assert got == Counter({d: length[d] * n for d, n in Counter(r["doc_id"] for r in before).items()})
    assert all(n <= 2048 and n & (n - 1) == 0 for n in size.values())


def test_run_gives_the_last_stage(spark, stages):
    drop = ("row_id", "sequence_id", "offset", "step_group", "start", "length", "ids_crc32", "sequence_length")
    total = lambda df: sorted(map(tuple, df.groupBy("doc_id").agg(F.sum("length")).collect()))
    out = cp.run(spark, SF)
    assert total(out) == total(stages[5]) and set(drop) < set(out.columns)


def test_stages_on_odd_rows(spark):
    lines = ["a line long enough\nown line number %d" % i for i in range(6)]
    ids = [None, 3, 3, *range(10, 10 + len(odd_texts()) + 3)]
    for docs in (empty(spark), frame(spark, odd_texts() + lines, ids=ids)):
        for name, stage in cp.STAGES:
            out = stored(stage(spark, docs, SF), "odd")
            assert name == "pack" or out.dtypes == docs.dtypes
            docs = out
        docs.collect()

from __future__ import annotations

import public_tokenizers
from sentencepiece import SentencePieceProcessor

import corpus_pipeline as own
from tests.llm.awkward import _EXTRA as EXTRA
from tests.llm.awkward import COLUMNS, awkward
from tests.llm.test_simhash import _components, _fingerprint


def _written(spark, frame, path):
    frame.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages_against_plain_code(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [row.text for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(own.STAGES):
        before = {row.doc_id: row for row in docs.collect()}
        columns = docs.columns
        docs = _written(spark, stage(spark, docs, sf_dir), tmp_path / str(number))
        after = {row.doc_id: row for row in docs.collect()}
        if name != "tokens":
            assert docs.columns == columns
        if name == "language":
            assert after == before
        elif name == "lines":
            seen, want = set(), {}
            places: dict[tuple, set] = {}
            for doc in sorted(before):
                lines = before[doc].text.split("\n")
                for at in range(len(lines) - 2):
                    window = tuple(lines[at : at + 3])
                    if window in seen:
                        places.setdefault(doc, set()).update((at, at + 1, at + 2))
                    seen.add(window)
                want[doc] = "\n".join(line for i, line in enumerate(lines) if i not in places.get(doc, ()))
            assert {doc: row.text for doc, row in after.items()} == want
        elif name == "near duplicates":
            ids = sorted(before)
            classes = _components(ids, [_fingerprint(before[doc].text) for doc in ids])
            assert set(after) == set(classes.values())
        elif name == "decontamination":
            assert all(not any(text in row.text for text in items) for row in after.values())
            gone = [before[doc] for doc in set(before) - set(after)]
            assert len(gone) < 0.1 * len(before)
        else:
            library = SentencePieceProcessor(model_file=public_tokenizers.path(own.TOKENIZER))
            assert {doc: row.token_ids for doc, row in after.items()} == {
                doc: library.encode(row.text) for doc, row in before.items()
            }
    assert sorted(row.doc_id for row in own.run(spark, sf_dir).collect()) == sorted(after)


def test_awkward_rows(spark, tmp_path):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    for number, (name, stage) in enumerate(own.STAGES):
        before = docs
        docs = _written(spark, stage(spark, docs, "/root/testdata/sf0.001"), tmp_path / str(number))
        if name != "tokens":
            assert docs.columns == before.columns
            # Columns that stages use names of keep their values.
            own_values = docs.drop("doc_id", "text", "lang", "source", "n_chars").distinct().collect()
            assert [tuple(row) for row in own_values] == [EXTRA]
    ids = [row.doc_id for row in docs.collect()]
    # 2 and 8 have lost all their lines to 1 and 7; of the two empty texts one is left.
    assert {1, 2, 7, 9, 10, 11, -7} <= set(ids) and not {3, 4, 5, 6, 8} & set(ids)
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in own.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0

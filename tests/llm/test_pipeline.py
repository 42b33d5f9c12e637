"""The corpus pipeline, stage by stage, against brute force on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from conftest import FOLDER, rows_of

from almanac.llm import simhash, toxicity
from almanac.sources import materialise, table


def test_stages_in_turn(spark, duck):
    docs = table(spark, FOLDER, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialise(stage(spark, kept[-1], FOLDER), "stage"))
        assert kept[-1].dtypes == docs.dtypes
    rows = [{r.doc_id: r for r in frame.collect()} for frame in kept]
    first, clean, lines, single, mix = rows

    model = toxicity.train(docs, table(spark, FOLDER, "labels"))
    toxic = {r.doc_id for r in toxicity.graded(docs, model).collect() if r.toxic}
    assert set(clean) == set(first) - toxic and all(clean[i] == first[i] for i in clean)

    assert set(lines) == set(clean)
    for i, row in lines.items():
        before, after = (clean[i].text or "").split("\n"), (row.text or "").split("\n")
        assert row.text == clean[i].text or [x for x in before if x in after][: len(after)] == after or after == [""]
    # A line that has words is left in one document only.
    seen: dict[str, int] = {}
    for i in sorted(lines):
        for line in {x for x in (lines[i].text or "").split("\n") if x.strip(" \t\x0b\f\r")}:
            assert seen.setdefault(" ".join(line.split()), i) == i

    prints = {i: simhash.fingerprint(r.text or "") for i, r in lines.items()}
    for i in lines:
        near = [j for j in lines if j != i and (prints[i] ^ prints[j]).bit_count() <= 4]
        assert (i in single) or any(j < i for j in near)
        assert i not in single or not any(j in single for j in near)
    assert all(single[i] == lines[i] for i in single)

    assert set(mix) <= set(single) and all(mix[i] == single[i] for i in mix)
    counts = {}
    for r in kept[4].collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 3

    final = corpus_pipeline.STAGES[-1][1](spark, kept[4], FOLDER)
    assert rows_of(final) == rows_of(corpus_pipeline.run(spark, FOLDER))
    assert final.count() == kept[4].count()


ODD = [
    (None, None, None, None, None), (None, "Some text without an id that nobody else has.", "en", "a", 46), (1, None, "en", None, None),
    (2, "", "en", "a", 0), (3, " \n\t", "en", "b", 3), (4, "The same words here again and again.", "en", "a", 36),
    (4, "The same words here again and again.", "en", "a", 36), (5, "The same words here again and again.", None, "b", 36),
    (6, "long words " * 20_000 + "\nand an end that is its own", "en", "b", 220_028), (7, "You idiot, you stupid clown.\nIdiot!", "en", "a", 37),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_stage_takes_odd_rows(spark):
    """Nulls in every column, texts without words, a long one, ties and repeated rows, and further columns."""
    docs = spark.createDataFrame([(*row, "x", "y") for row in ODD], f"{COLUMNS}, _doc string, label string")
    clean, lines, single, mix, last = (dict(corpus_pipeline.STAGES)[name] for name, _ in corpus_pipeline.STAGES)
    columns = list(corpus_pipeline.COLUMNS)

    kept = clean(spark, docs, FOLDER)
    assert kept.columns == columns and kept.filter("doc_id = 7").count() in (0, 1)
    assert rows_of(kept.filter("doc_id is null or doc_id <> 7"), *columns) == rows_of(docs.filter("doc_id is null or doc_id <> 7"), *columns)

    found = lines(spark, docs, FOLDER)
    texts = [tuple(r) for r in found.select("doc_id", "text", "n_chars").collect()]
    assert found.columns == columns and len(texts) == len(ODD)
    assert texts.count((4, ODD[5][1], 36)) == 2 and (5, "", 0) in texts and (1, None, None) in texts and (3, " \n\t", 3) in texts

    found = single(spark, docs, FOLDER)
    assert found.columns == columns
    assert rows_of(found, "doc_id", "text") == sorted([(1, None), (4, ODD[5][1]), (6, ODD[8][1]), (7, ODD[9][1])]) + [(None, ODD[1][1])]

    found = mix(spark, docs, FOLDER)
    assert found.columns == columns and {r.doc_id for r in found.collect()} <= {None, 4, 5, 6, 7}
    assert found.groupBy("doc_id").count().filter("doc_id = 6 AND count > 3").isEmpty()

    tokens = [tuple(r) for r in last(spark, docs, FOLDER).collect()]
    assert len(tokens) == len(ODD) and len({t for t in tokens if t[0] == 4}) == 1
    assert sorted(t[1] for t in tokens if t[0] in (1, 2)) == [0, 0]


def test_every_stage_takes_no_rows(spark):
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert not stage(spark, empty, FOLDER).collect()


def test_a_run_in_a_folder_gives_the_same_and_leaves_one_table(spark, tmp_path):
    wanted = rows_of(corpus_pipeline.run(spark, FOLDER))
    assert rows_of(corpus_pipeline.run(spark, FOLDER, str(tmp_path / "run"))) == wanted
    left = sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "run").iterdir())
    assert left == ["byte-level-bpe", "manifest"]
    again = corpus_pipeline.resumable(spark, FOLDER, str(tmp_path / "run"))
    assert [again.state(s.name) for s in again.stages] == ["released"] * 4 + ["done"]
    assert rows_of(again.result()) == wanted
    again.close()
    assert not (tmp_path / "run").exists()

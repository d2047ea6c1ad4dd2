"""Every stage on its own input against plain Python; edge cases of the row-keeping forms."""

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from posefold.llm.common import table
from posefold.llm.decontaminate import clean_documents, contaminated
from posefold.llm.exact_dedup import unique_documents
from posefold.llm.packing import cut_lengths
from posefold.llm.quality import classify
from posefold.llm.simhash import one_of_each

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_set_join import staying  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents").cache()
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "decontamination", "packing"]
    quality, exact, near, clean, packing = (f for _, f in corpus_pipeline.STAGES)

    kept = quality(spark, docs, SF)
    good = {r.doc_id for r in classify(docs, table(spark, SF, "labels")).collect() if r.predicted}
    rows = kept.collect()
    assert kept.columns == columns and {r.doc_id for r in rows} == good and 0 < len(good) < docs.count()

    docs = kept.cache()
    kept = exact(spark, docs, SF)
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    rows = sorted(kept.collect(), key=lambda r: r.doc_id)
    assert kept.columns == columns and rows == sorted(first.values(), key=lambda r: r.doc_id)

    docs = kept.cache()
    kept = near(spark, docs, SF)
    stay = staying({r.doc_id: r.text for r in rows})
    seen = {r.doc_id for r in rows}
    rows = [r for r in rows if r.doc_id in stay]
    assert kept.columns == columns and sorted(kept.collect(), key=lambda r: r.doc_id) == rows and len(stay) < len(seen)

    docs = kept.cache()
    kept = clean(spark, docs, SF)
    leaks = {r.doc_id for r in contaminated(docs, table(spark, SF, "benchmark")).collect()}
    rows = [r for r in rows if r.doc_id not in leaks]
    assert kept.columns == columns and sorted(kept.collect(), key=lambda r: r.doc_id) == rows and leaks

    packed = packing(spark, kept, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}
    sizes = {}
    for r in packed:
        sizes.setdefault(r.doc_id, []).append((r.piece, r.length))
    for own in sizes.values():
        lengths = [n for _, n in sorted(own)]
        assert lengths == cut_lengths(sum(lengths), 1024)

    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


ODD = [(1, "a b", 0), (1, "a b", 0), (1, "c", 0), (2, "a  b", 0), (None, "c", 0), (None, None, 0), (None, "", 0), (3, None, 0), (4, "z " * 9, 0), (5, "z " * 9, 0)]
SCHEMA = "doc_id long, text string, kept int"


def test_row_keeping_forms(spark):
    frame = spark.createDataFrame(ODD, SCHEMA)
    got = sorted(map(str, map(tuple, unique_documents(frame).collect())))
    assert got == sorted(map(str, [(1, "a b", 0), (1, "c", 0), (3, None, 0), (4, "z " * 9, 0)]))
    ids = sorted(str(r.doc_id) for r in one_of_each(frame, 4, 4).collect())
    assert "5" not in ids and ids.count("None") == 3 and "4" in ids
    benchmark = spark.createDataFrame([(1, "z z z z z"), (2, None)], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in clean_documents(frame, benchmark).collect()).count("4") == 0
    assert clean_documents(frame, benchmark.limit(0)).count() == len(ODD)
    for form in (unique_documents, one_of_each):
        assert form(frame.limit(0)).count() == 0

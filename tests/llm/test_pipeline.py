import importlib

import corpus_pipeline as P
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tablespan.llm import personal
from tablespan.sources.shared import kept
from tests.llm.frames import SMALL, documents, given
from tests.llm.test_decontamination import expected as contaminated
from tests.llm.test_jaccard import expected as groups

stages = dict(P.STAGES)


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_are_in_order():
    assert [name for name, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert P.ORACLE_SQL is None and "pipeline" in importlib.import_module("__spark_entry__").queries()


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    langs = {d["doc_id"]: d["lang"] for d in given("documents")}

    one = kept(spark, stages["language"](spark, docs, SMALL))
    assert one.columns == columns and len(texts(one)) >= 0.97 * len(langs)

    two = kept(spark, stages["near_duplicates"](spark, one, SMALL))
    before = texts(one)
    assert two.columns == columns and texts(two) == {i: before[i] for i, _, c in groups(list(before.items())) if i == c}

    three = kept(spark, stages["decontamination"](spark, two, SMALL))
    before = texts(two)
    rows = contaminated(list(before.items()), [(b["item_id"], b["text"]) for b in given("benchmark")])
    assert three.columns == columns and texts(three) == {r[0]: before[r[0]] for r in rows if not r[5]}
    assert len(texts(three)) < len(before)

    four = kept(spark, stages["personal_data"](spark, three, SMALL))
    before, after = texts(three), texts(four)
    assert four.columns == columns and set(before) == set(after) and before != after
    spans = {r.doc_id: r.spans for r in personal.personal_data(spark, three).collect()}
    for i, text in before.items():
        out, end = "", 0
        for s in spans[i]:
            if s.start >= end:
                out += text[end : s.start] + f"[{s.kind.upper()}]"
            end = max(end, s.stop)
        assert after[i] == out + text[end:]
    assert all(r.n_chars == len(r.text) for r in four.collect())

    five = stages["packing"](spark, four, SMALL)
    assert {r.doc_id for r in five.select("doc_id").distinct().collect()} == set(after)


def test_run_gives_the_last_stage(spark):
    assert P.run(spark, SMALL).agg({"length": "sum"}).first()[0] > 0


def odd(spark):
    rows = [(1, None), (2, ""), (3, "the and of it was that " * 9), (3, "the and of it was that " * 9), (3, "another the and of text entirely, that it was"), (None, "the and of it was that " * 9)]
    rows += [(i, f"the and of it mail x{i}@y.zz or 10.0.0.{i} {'🙂é' * i} that was number {i} of them") for i in range(10, 30)]
    return documents(spark, rows)


def test_odd_documents_and_clashing_names(spark):
    docs = kept(spark, odd(spark))
    for name, stage in P.STAGES[:-1]:
        result = kept(spark, stage(spark, docs, SMALL))
        assert result.schema == docs.schema, name
        assert kept(spark, stage(spark, docs.limit(0), SMALL)).count() == 0
    deduplicated = stages["near_duplicates"](spark, docs, SMALL).collect()
    assert sum((r.text or "").startswith("the and of it was that") for r in deduplicated) == 1
    assert sum(r.doc_id == 3 for r in deduplicated) == 2 and {1, 2} <= {r.doc_id for r in deduplicated}
    masked = texts(stages["personal_data"](spark, docs, SMALL))
    assert masked[12] == "the and of it mail [EMAIL] or [IP] " + "🙂é" * 12 + " that was number 12 of them" and masked[1] is None
    assert stages["packing"](spark, docs.limit(0), SMALL).count() == 0


def test_intermediate_tables_are_dropped_by_the_next_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = lambda f: path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(f))
    P._made.clear()
    lazy = stages["decontamination"](spark, docs, SMALL)
    stages["decontamination"](spark, docs, SMALL)
    made = list(P._made["decontamination"])
    assert stages["personal_data"](spark, lazy, SMALL).count() > 0 and all(map(there, made))  # still read
    stages["personal_data"](spark, kept(spark, lazy), SMALL)
    assert made and not any(map(there, made)) and not P._made["decontamination"]
    packed = stages["packing"](spark, docs, SMALL)
    stages["language"](spark, docs, SMALL)
    assert packed.count() > 0 and "packing" not in P._made


def test_a_task_holds_few_texts_at_once(spark, tmp_path):
    docs = spark.range(0, 240, 1, 1).select("id", F.expr("concat_ws('', transform(sequence(1, 1500), k -> sha2(concat(id, ':', k), 256)))").alias("text"))
    plain = P._stage(after=None, last=True)(lambda spark, docs, sf_dir: docs)
    plain(spark, docs, SMALL).write.parquet(f"{tmp_path}/docs")
    (file,) = tmp_path.glob("docs/*.parquet")
    groups = pq.ParquetFile(file).metadata
    sizes = [sum(groups.row_group(i).column(c).total_compressed_size for c in range(2)) for i in range(groups.num_row_groups)]
    assert sum(sizes) > 12 << 20 and max(sizes) < 10 << 20  # 128 MB by default

    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.get_total_buffer_size()])], names=["n", "bytes"])

    seen = spark.read.parquet(f"{tmp_path}/docs").mapInArrow(measure, "n long, bytes long").collect()
    assert sum(r.n for r in seen) == 240 and max(r.n for r in seen) <= 1 + (1 << 20) // 96_000
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512

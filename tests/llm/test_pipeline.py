import random

import corpus_pipeline as P
from tests.llm import brute, data
from threadlens.llm import common as C


def table(spark, rows, tmp):
    df = data.frame(spark, rows).select(*P.COLUMNS)
    spark.createDataFrame([(i, 1, int("idiot" in (t or ""))) for i, t in rows if i is not None],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    df.write.parquet(f"{tmp}/documents.parquet")
    return str(tmp)


def test_stages_as_brute_force(spark, tmp_path):
    r = random.Random(8)
    rows = data.rows(71, 160)
    rows += [(20_000 + k, " ".join(["idiot scum", *(r.choice("abcdefgh") * r.randint(1, 5) for _ in range(30))]))
             for k in range(60)]
    d = table(spark, [*rows, (None, "nobody")], tmp_path)
    docs = C.documents(spark, d)
    kept = P.toxicity_stage(spark, docs, d)
    ids = {x.doc_id for x in kept.select("doc_id").collect()}
    assert ids == {i for i, _ in rows if i < 20_000} and kept.columns == list(P.COLUMNS)
    kept = C.stage(kept, "t1")
    clean = [(i, t) for i, t in rows if i in ids]
    deduped = C.stage(P.near_dedup_stage(spark, kept, d), "t2")
    stay = {i for i, _, _, k in brute.near_groups(clean) if k}
    assert {x.doc_id for x in deduped.select("doc_id").collect()} == stay
    cut = C.stage(P.suffix_dedup_stage(spark, deduped, d), "t3")
    want = {i: n - g for i, n, g, _, _ in brute.suffix_dedup([x for x in clean if x[0] in stay])}
    for x in cut.collect():
        assert want[x.doc_id] <= len(x.text.encode()) <= want[x.doc_id] + 8 * 50 and x.n_chars == len(x.text)
        assert len(x.text.encode()) == want[x.doc_id] or not x.text.isascii()
    assert cut.count() == len(stay)
    pieces = P.packing_stage(spark, cut, d)
    assert {x.doc_id for x in pieces.select("doc_id").distinct().collect()} == stay


def test_columns_stay_with_their_row(spark, tmp_path):
    rows = data.rows(72, 40)[:-1]
    rows += [(rows[20][0], "another text under the same id"), (rows[21][0], rows[21][1])]
    docs = spark.createDataFrame([(i, t, f"l{k}" if k % 3 else None, f"s{k}", None) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = P.suffix_dedup_stage(spark, docs, "").collect()
    assert sorted((r.doc_id, r.lang or "", r.source) for r in got) == \
        sorted((i, f"l{k}" if k % 3 else "", f"s{k}") for k, (i, _) in enumerate(rows))
    own = {r.source: r.text for r in got}
    assert own[f"s{len(rows) - 2}"] == "another text under the same id"


def test_empty_pipeline(spark, tmp_path):
    d = table(spark, [], tmp_path)
    assert P.run(spark, d).collect() == []


def test_entry_registers_all():
    import __spark_entry__ as e
    names = set(e.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import assert_equal, connect  # noqa: E402
from starsmelt.llm import (  # noqa: E402
    chat,
    decontamination,
    line_dedup,
    ngram_join,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    token_counts,
)
from starsmelt.llm.components import components  # noqa: E402
from starsmelt.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, root int"
PASSAGE = " ".join(f"passage{k}" for k in range(60))
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\r ", None, None), (4, "one", "en", None),
    (5, "a b c", "en", "a"), (6, "A B  c", "en", "a"), (7, "b a c", "en", "a"),
    (8, "it's <|endoftext|> İ ﬁ \x1c ▁ x▁ y\x00 é日本 <s> don't", "en", "a"),
    (9, "be " * 900, "en", "a"), (10, "be " * 900, "en", "a"), (10, "be " * 900, "en", "a"),
    (None, "no id here " * 30, "en", "a"), (11, "x" * 9000, "en", "b"),
    (12, "head one two " + PASSAGE + " tail\n  Same LINE here \nlast", "en", "b"),
    (13, "other start " + PASSAGE + " end\nsame line HERE\n", "en", "b"),
    (14, PASSAGE + " " + PASSAGE.upper(), "en", "b"),
    (15, " ".join(f"w{k}" for k in range(4000)), "en", "b"),
    (16, " ".join(f"w{k}" for k in range(4000) if k != 7), "en", "b"),
    (17, "###" + " word" * 5 + " $$$ |||", "de", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, src, 0, "clash", 7) for i, t, lang, src in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    assert_equal(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE_SQL[name])


def test_near_duplicates(spark, odd, empty):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for df in (docs, odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        found = {r[0]: (r[1], r[2]) for r in ngram_join.near_duplicates(df).collect()}
        assert found == brute.near_duplicates(texts(df))
    rows = ngram_join.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert not ngram_join.near_duplicates(empty).collect()


@pytest.mark.parametrize("turned", [False, True])
def test_texts_of_one_id_are_one_document(spark, turned):
    """Whatever any of its texts links with is linked, in every order of the rows."""
    words = lambda tag, n=40: [f"{tag}{k}" for k in range(n)]
    near = lambda tag: " ".join(["changed", *words(tag)[1:]])
    whole = lambda tag: " ".join(words(tag))
    rows = [(1, whole("a")), (5, near("a")), (5, near("b")), (9, whole("b")), (9, whole("b")), (7, whole("c")),
            (12, near("c")), (12, None), (12, ""), (20, whole("d")), (20, whole("e")), (30, near("e")), (30, near("e")),
            (3, whole("f")), (2, whole("f")), (2, whole("g")), (4, near("g")), (None, whole("a")), (None, None),
            (40, "x y"), (41, "x y"), (41, "y x")]
    rows = rows[::-1] if turned else rows
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = [tuple(r) for r in ngram_join.near_duplicates(df).collect()]
    assert sorted(found, key=repr) == sorted(brute.near_rows(rows), key=repr)
    roots = {doc: root for doc, n, root in found if n}
    assert roots[9] == roots[5] == 1 and roots[12] == 7 and roots[30] == 20 and roots[4] == 2


def test_rows_without_partners_leave_crowded_regions(spark, monkeypatch):
    """Texts of one template with one differing word: far apart, but all share rare-looking shingles."""
    monkeypatch.setattr(ngram_join, "REGION", 30)
    rng = np.random.default_rng(8)
    rows = []
    for doc in range(300):
        words = [f"t{k}" for k in range(24)]
        words[int(rng.choice([1, 12, 22, 23]))] = f"x{rng.integers(250)}"
        rows.append((doc, " ".join(words[:int(rng.choice([23, 24]))])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: (r[1], r[2]) for r in ngram_join.near_duplicates(df).collect()}
    assert found == brute.near_duplicates(rows)
    met = spark.createDataFrame(
        [(7, k, 9, 1) for k in range(50)] + [(8, 60, 100, 2), (8, 61, 104, 3), (8, 62, 300, 0), (9, 70, 10, 0), (9, 71, 9, 1)],
        "pivot long, doc long, n int, at int")
    kept = {r["doc"] for r in ngram_join._with_partners(met, 85).collect()}
    assert kept >= {60, 61, 62, 70} and not kept & set(range(50))


def test_near_duplicates_in_crowded_regions(spark, monkeypatch):
    """Many loose copies of one text, with all limits low so that every path is taken."""
    monkeypatch.setattr(ngram_join, "SMALL", 3)
    monkeypatch.setattr(ngram_join, "REGION", 20)
    monkeypatch.setattr(ngram_join, "ROUNDS", (1,))
    rng = np.random.default_rng(3)
    rows = []
    for doc in range(120):
        words = [f"t{k}" for k in range(60)]
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            words[at] = f"x{rng.integers(1000)}"
        rows.append((doc, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: (r[1], r[2]) for r in ngram_join.near_duplicates(df).collect()}
    assert found == brute.near_duplicates(rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 30)] + [(50, 40), (60, 50), (7, 7), (3, 2)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in components(df).collect()}
    assert found == {**{k: 1 for k in range(1, 31)}, 40: 40, 50: 40, 60: 40}
    assert not components(df.filter("a < 0")).collect()


@pytest.mark.parametrize("hot", [20_000, 0])
def test_remove_repeats(spark, odd, empty, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).unionByName(
        odd.select("doc_id", "text"), allowMissingColumns=True)
    found = [tuple(r) for r in suffix_dedup.digest(suffix_dedup.remove_repeats(docs)).collect()]
    assert sorted(found, key=str) == sorted(brute.remove_repeats(texts(docs)), key=str)
    assert not suffix_dedup.remove_repeats(empty).collect()


def test_run_length_index():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, 60, dtype=np.uint8)) for _ in range(40)]
    counts, length = np.full(40, 61 - 8), 8
    index = suffix_dedup.RunLengthIndex(texts, counts, np.ones(40, np.int64), length)
    windows = [t[k:k + length] for t in texts for k in range(53)]
    assert [windows[k] for k in index.order] == sorted(windows)
    assert index.runs()[1].sum() == len(windows)
    assert index.repeated().tolist() == [windows.count(w) > 1 for w in windows]


def test_pieces_and_sequences(spark, odd, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    docs = odd.dropDuplicates(["doc_id"])
    rows = packing.pack_documents(docs, path).collect()
    expected = brute.pieces(texts(docs), Tokenizer.from_file(path))
    assert {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows} == expected
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in by_sequence.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 2048
    assert not packing.pack_documents(empty, path).collect()


@pytest.mark.parametrize("histogram", [{}, {1: 5000}, {2048: 3}, {100: 1000}, {1500: 7, 600: 9, 500: 2, 48: 30}])
def test_shortest_pack_first(histogram):
    fill = {}
    placed = dict.fromkeys(histogram, 0)
    for length, rank, count, first, offset in packing.shortest_pack_first(histogram, 2048):
        assert rank == placed[length]
        placed[length] += count
        for sequence in range(first, first + count):
            assert fill.get(sequence, 0) == offset
            fill[sequence] = offset + length
    assert placed == histogram and all(x <= 2048 for x in fill.values())
    least = sum(k * n for k, n in histogram.items()) / 2048
    assert len(fill) <= 1.2 * least + 3


def test_token_counts(spark, odd, empty):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(
        odd.select("doc_id", "text"))
    found = sorted((tuple(r) for r in token_counts.count_tokens(docs, path).collect()), key=str)
    expected = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in texts(docs)]
    assert found == sorted(expected, key=str)
    assert not token_counts.count_tokens(empty, path).collect()


def test_passages_of_short_and_long_items(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, PASSAGE), (2, "One"), (3, None), (4, "..."), (None, "be be"), (5, "A, b C"), (6, "be be be")],
        "item_id long, text string")
    found = {r["doc_id"]: r for r in decontamination.find_passages(odd, items).collect()}
    assert (found[1]["n_words"], found[1]["n_hit"], found[1]["items"]) == (0, 0, [])
    assert (found[12]["n_hit"], found[12]["items"]) == (61, [1, 2])
    assert (found[14]["n_words"], found[14]["n_hit"]) == (120, 120)
    assert found[4]["items"] == [2] and found[5]["items"] == [5] and found[7]["items"] == []
    assert found[9]["n_hit"] == 900
    blocks = decontamination.find_passages(odd, items, block_bytes=1)
    one = decontamination.find_passages(odd, items)
    key = lambda rows: sorted(map(str, rows.select("doc_id", "n_words", "n_hit", "items").collect()))
    assert key(blocks) == key(one)
    assert not decontamination.find_passages(empty, items).collect()
    assert all(r["n_hit"] == 0 for r in decontamination.find_passages(odd, items.limit(0)).collect())


def test_lines(spark, odd, empty):
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(odd, keep=("score",)).collect()}
    assert found[12]["n_dropped"] == 0 and found[13]["n_dropped"] == 1
    assert found[13]["text"].endswith(" end\n") and found[13]["score"] == "clash"
    assert (found[1]["text"], found[1]["n_lines"]) == ("", 1)
    assert found[9]["n_dropped"] == 0 and found[10]["n_dropped"] == 1
    assert not line_dedup.dedup_lines(empty).collect()
    three = line_dedup.dedup_lines(odd, min_docs=3)
    assert three.agg(F.sum("n_dropped")).first()[0] == 0


def test_chats_read_back(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", None), (1, 2, "assistant", r"<turn:x>\l<part/></turn>"),
            (1, 2, "assistant", r"<turn:x>\l<part/></turn>"), (None, None, None, None), (2, 5, "a>b<", "é"),
            (1, 3, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df)
    read = {r["conv_id"]: r for r in chat.read_chats(out).collect()}
    assert [tuple(t) for t in read[1]["turns"]] == [
        ("user", "a"), ("user", ""), ("assistant", rows[2][3]), ("assistant", rows[2][3]), ("assistant", "")]
    assert read[1]["loss_text"] == rows[2][3] * 2
    assert [tuple(t) for t in read[2]["turns"]] == [("a>b<", "é")]
    for r in out.collect():
        assert sum(x["n"] for x in r["loss"]) == len(r["formatted"])
    assert not chat.format_chats(df.limit(0)).collect()


def test_chats_with_ties_equal_sql(spark, tmp_path):
    """Equal and null turn numbers, and texts that escaping would put in another order."""
    rows = [(1, 0, "user", "=a"), (1, 0, "user", "<a"), (1, 0, "user", "\\a"), (1, 0, "assistant", ">"), (1, None, "user", "z"),
            (1, None, None, "<"), (1, 3, "a<", "q"), (1, 3, "a=", "q"), (2, None, "assistant", None), (2, None, "assistant", "<"),
            (None, 1, "user", "x"), (None, 1, "user", "x"), (3, 2, "assistant", "="), (3, 2, "assistant", "<")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    duck = connect(FOLDER)
    duck.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert_equal(chat.digest(chat.format_chats(chat.with_control_case(df))), duck, chat.SQL)
    read = {r["conv_id"]: r for r in chat.read_chats(chat.format_chats(df)).collect()}
    assert [tuple(t) for t in read[3]["turns"]] == [("assistant", "<"), ("assistant", "=")]


def test_every_row_is_decontaminated_by_its_own_text(spark, tmp_path):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = " ".join(f"w{k}" for k in range(50))
    rows = [(5, item), (5, clean), (None, item), (None, clean), (6, None), (6, ""), (7, clean), (7, clean), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, items string, row int")
    kept = corpus_pipeline.decontaminate(spark, df, FOLDER)
    assert sorted(texts(kept), key=repr) == sorted([r for r in rows if r[1] != item], key=repr)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    found = decontamination.find_passages(df, items, block_bytes=1, keep=("text", "row"))
    assert sorted(texts(decontamination.contaminated(found).filter("NOT contaminated")), key=repr) == sorted(
        [r for r in rows if r[1] != item], key=repr)
    assert {r["row"] for r in found.collect()} == {2}


def test_stages_on_odd_rows(spark, odd, empty, tmp_path):
    """Nulls, repeated rows, clashing columns and no rows at all, in every stage."""
    folder = str(tmp_path)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    total = {"line dedup": len(ODD)}
    for name, step in corpus_pipeline.STAGES:
        some = step(spark, odd, folder)
        assert name == "packing" or some.columns == list(corpus_pipeline.COLUMNS)
        assert some.count() == total.get(name, some.count()) and some.count() > 0
        assert step(spark, empty, folder).count() == 0
    near = dict(corpus_pipeline.STAGES)["n-gram jaccard join"](spark, odd, folder)
    kept = [doc for doc, _, root in brute.near_rows([r[:2] for r in ODD], 5, 80) if doc == root]
    assert sorted((i for i, _ in texts(near)), key=repr) == sorted(kept, key=repr) and 1 < len(kept) < len(ODD) - 3


def test_shards(spark, odd, empty):
    table = sharding.lookup_table(spark, 5, 101).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in table) == [20, 20, 20, 20, 21]
    assert sharding.assign_shards(odd, shards=5, slots=101).count() == len(ODD)
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, 5, 100)


def test_rules(spark, odd, empty):
    rows = quality_rules.apply_rules(odd).collect()
    assert len(rows) == len(ODD)
    failed = {r["doc_id"] for r in rows if r["base_failed"]}
    assert {1, 2, 3, 4, 9, 10} <= failed and 15 not in failed
    assert not quality_rules.apply_rules(empty).collect()


def test_fences_hold_where_junk_is_a_quarter_or_a_group_of_its_own(spark):
    """Clean texts stay and junk goes: in a hot source, in a group of one, among copies; SQL agrees."""
    def text(i, mark=""):
        return " ".join(f"{mark}{'abcdefgh'[: 3 + (i * 7 + k) % 5]}{chr(97 + (i + k) % 26)}{chr(97 + k % 26)}"
                        for k in range(40))

    rows = [(i, text(i), "en", "hot") for i in range(90)]
    rows += [(100 + i, text(i, "#$%"), "en", "hot") for i in range(30)]
    rows += [(200, text(1, "#$%"), "xx", "alone"), (201, text(2), None, None), (202, None, "en", "hot")]
    rows += [(300 + i, text(3), "de", "copies") for i in range(60)] + [(400, text(4), "de", "copies")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs).collect()}
    bad = {*range(100, 130), 200, 202}
    assert {doc for doc, kept in found.items() if not kept} == bad and len(found) == len(rows)
    with duckdb.connect() as db:
        db.register("documents", docs.toPandas())
        told = db.execute(f"SELECT doc_id, kept FROM ({quality_rules.SQL})").fetchall()
    assert dict(told) == found


def test_classifier(spark, odd, empty):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, labels)
    held = quality_classifier.score(docs, model).join(labels, "doc_id").filter(
        quality_classifier.held_out(F.col("doc_id")))
    right = held.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    again = quality_classifier.fit(docs.repartition(7), labels)
    assert np.array_equal(model.weights, again.weights)
    rows = quality_classifier.score(odd, model, keep=("lang",)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.fit(docs, labels.limit(0)).scores([b"", b"x y"]).tolist() == [0.5, 0.5]
    assert not quality_classifier.score(empty, model).collect()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    quality, lines, near, clean, _ = (f for _, f in corpus_pipeline.STAGES)
    kept = quality(spark, docs, FOLDER)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    cut = lines(spark, kept, FOLDER)
    assert cut.columns == docs.columns and cut.count() == kept.count()
    single = near(spark, cut, FOLDER)
    groups = brute.near_duplicates(texts(cut), 5, 80)
    assert {r[0] for r in texts(single)} == {doc for doc, (_, root) in groups.items() if doc == root}
    assert clean(spark, single, FOLDER).columns == docs.columns
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).filter(
        "n <> t").count() == 0

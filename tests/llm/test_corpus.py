import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from lodemark.llm import quality, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert set(queries.ORACLES) <= set(names)


def test_the_library_works_without_the_corpus_part(tmp_path):
    code = ("import sys; sys.modules['lodemark.llm'] = None\nimport importlib.abc\n"
            "import __spark_entry__ as e; assert not any(q.startswith('op') for q in e.queries()) and e.oracle_sql()")
    hide = "class H:\n def find_spec(s, n, p=None, t=None):\n  if n.startswith('lodemark.llm') or n == 'corpus_pipeline': raise ModuleNotFoundError(n, name=n)\nimport sys; sys.meta_path.insert(0, H())\n"
    subprocess.run([sys.executable, "-c", hide + code.split("\n", 1)[1]], check=True, cwd=".")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    from test_text_operators import edited, passage, prose
    shared = passage("shared", 6)
    rows = [(k, f"{passage(f'own{k}', 8)} {shared if k % 3 == 0 else ''}", "en", f"s{k % 4}", None) for k in range(30)]
    rows += [(100 + k, rows[k % 3][1], "en", "hot", None) for k in range(9)] + [(200 + k, edited(prose("near", 200), k, 1), "en", "hot", None) for k in range(9)]
    rows += [(300, None, None, None, None), (301, "", None, None, None), (302, "too short", "en", "s", None), (303, "12 34 56 78 " * 40, "en", "s", None), (0, rows[0][1], "en", "s0", None)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append((before, docs.collect()))
    return spark, folder, out


def test_stages_decide_on_all_their_input(stages):
    from test_text_operators import brute_force_groups, brute_force_spans
    spark, folder, ((docs, good), (_, spoken), (_, single), (_, fresh), (_, bins)) = stages
    assert {r.doc_id for r in docs} - {r.doc_id for r in good} == {300, 301, 302, 303}
    assert {r.doc_id for r in spoken} == {r.doc_id for r in good if any(c.isalpha() for c in r.text or "")} and spoken
    groups = brute_force_groups([(r.doc_id, r.text) for r in spoken])
    assert {r.doc_id for r in single} == {low for _, _, low in groups}
    cleaned = brute_force_spans([(r.doc_id, r.text) for r in single])
    assert {r.doc_id: r.text for r in fresh} == {key[0]: text for key, text in cleaned.items() if text.strip()}
    assert all(r.n_chars == len(r.text) for r in fresh if r.n_chars is not None)
    assert sorted((r.doc_id, r.piece_length) for r in bins) == sorted((r.doc_id, len((r.text or "").split())) for r in fresh)
    placed = {r.doc_id: (r.bin, r.bin_offset) for r in bins}
    assert {r.bin_block for r in bins} == {bins[0].bin_block} and placed == plain_best_fit(fresh)


def plain_best_fit(docs):
    """Longest first, ties by id, into the fullest bin with room, no equal source and no equal text."""
    open_bins, out = [], {}
    for r in sorted(docs, key=lambda r: (-len(r.text.split()), r.doc_id)):
        n = len(r.text.split())
        fits = [(corpus_pipeline.CAPACITY - b["used"], k) for k, b in enumerate(open_bins)
                if b["used"] + n <= corpus_pipeline.CAPACITY and r.source not in b["sources"] and r.text not in b["texts"]]
        k = min(fits)[1] if fits else len(open_bins)
        if not fits:
            open_bins.append({"used": 0, "sources": set(), "texts": set()})
        out[r.doc_id] = (k, open_bins[k]["used"])
        open_bins[k]["used"] += n
        open_bins[k]["sources"].add(r.source)
        open_bins[k]["texts"].add(r.text)
    return out


WIDE = DOCS + ", lang_pred string, score double, row string"


def test_language_stage_keeps_what_it_cannot_name(spark):
    """Without labels every document stays; texts in several languages stay; only texts without a letter go."""
    from test_text_operators import speech
    unlabelled = [(k, f"some words number {k}", None, "s", None, "a", 0.5, "b") for k in range(30)] + [(30, None, None, "s", None, "a", 0.5, "b")]
    rows = corpus_pipeline.language_id(spark, spark.createDataFrame(unlabelled, WIDE), "").collect()
    assert sorted(r.doc_id for r in rows) == list(range(31)) and {(r.lang_pred, r.score, r.row) for r in rows} == {("a", 0.5, "b")}
    tongues = ["aa", "bb", "cc"]
    labelled = [(k, speech(tongues[k % 3], k), tongues[k % 3], "s", None, "a", 0.5, "b") for k in range(60)]
    mixed = [(100, " ".join(speech(t, 900 + i) for i, t in enumerate(tongues)), None, "s", None, "a", 0.5, "b"),
             (101, "12 34 !", "aa", "s", None, "a", 0.5, "b"), (102, None, "aa", "s", None, "a", 0.5, "b"), (103, "x" * 1_200_000, None, "s", None, "a", 0.5, "b")]
    rows = corpus_pipeline.language_id(spark, spark.createDataFrame(labelled + mixed, WIDE), "").collect()
    assert sorted(r.doc_id for r in rows) == [*range(60), 100, 103]


def test_many_languages_are_learned_and_too_many_do_not_stop(spark):
    from lodemark.llm import langid
    rows = [(k, "".join(chr(0x4E00 + 40 * (k % 90) + j) for j in range(30)), f"l{k % 90:02d}", "s", None) for k in range(180)]
    df = spark.createDataFrame(rows, DOCS)
    assert len(langid.learn(df, "text", "lang").names) == 90
    few = langid.learn(df.unionAll(df.where("lang = 'l07'")), "text", "lang", max_languages=5)
    assert len(few.names) == 5 and "l07" in few.names


def test_run_equals_the_stages(stages):
    spark, folder, out = stages
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(str, rows)) == sorted(map(str, out[-1][1]))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

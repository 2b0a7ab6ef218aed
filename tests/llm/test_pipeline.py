import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from quartergrid.llm.common import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The result of every stage on the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in cp.STAGES:
        docs = out[name] = staged(stage(spark, docs, SF), name)
    return out


def test_stages_keep_the_columns_of_documents(kept):
    for name, _ in cp.STAGES[:-1]:
        assert kept[name].columns == list(cp.COLUMNS)


def test_decisions_take_effect(spark, kept):
    from quartergrid.llm.decontamination import contamination
    from quartergrid.llm.jaccard_join import jaccard_classes
    from quartergrid.llm.line_dedup import dedup_lines
    from quartergrid.llm.quality_rules import quality_verdicts

    def ids(df):
        return sorted(r[0] for r in df.select("doc_id").collect())

    assert ids(kept["quality_rules"]) == ids(quality_verdicts(kept["documents"]).filter("kept"))
    lines = {r["doc_id"]: r["kept_text"] for r in dedup_lines(kept["quality_rules"], 1).collect()}
    after = {r["doc_id"]: r["text"] for r in kept["line_dedup"].collect()}
    assert after == {k: t for k, t in lines.items() if t.split()}
    assert ids(kept["jaccard_join"]) == ids(
        jaccard_classes(kept["line_dedup"], 5, 80).filter("doc_id = component_id"))
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(kept["decontamination"]) == ids(contamination(kept["jaccard_join"], items).filter("not contaminated"))
    assert ids(kept["best_fit_packing"].filter("piece = 0")) == ids(kept["decontamination"])


def test_clean_labelled_documents_pass_the_quality_stage(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    long = kept["documents"].join(labels, "doc_id").filter(F.size(F.split("text", " ")) > 20)
    lost = long.join(kept["quality_rules"], "doc_id", "left_anti").count()
    assert long.count() > 50 and lost <= 0.02 * long.count()


def test_empty_and_awkward_documents(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, tag_ string, goes int"
    sentence = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, sentence, "en", "s", 5), (3, sentence, "en", "s", 5),
            (4, sentence, "en", "s", 5), (None, sentence, None, "s", 5)]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], kinds)
    for some in (docs, docs.filter("false")):
        for name, stage in cp.STAGES:
            some = staged(stage(spark, some, SF), name)
        if some.count():
            assert sorted(str(r["doc_id"]) for r in some.collect()) == ["3", "None"]


def test_run_equals_brute_force(spark, tmp_path):
    """Texts of like words: bands are wide, so the first stage is its base rules."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from .cases import docs, prose
    from .test_decontamination import brute as hits
    from .test_jaccard_join import brute as classes
    from .test_line_dedup import brute as lines
    from .test_quality_rules import base

    rng = random.Random(11)
    items = [(i, " ".join(prose(rng, 25))) for i in range(4)]
    stock = [" ".join(prose(rng, rng.randrange(6, 20))) for _ in range(8)]
    texts = [(i, "\n".join(" ".join(prose(rng, 15)) for _ in range(4))) for i in range(16)]
    texts += [(20 + i, texts[i][1]) for i in range(3)]  # copies
    texts += [(30 + i, texts[i][1].replace(" ", " x ", 2)) for i in range(3)]  # near copies, line by line
    texts += [(40 + i, " ".join([*prose(rng, 30), *items[i][1].split()[i : i + 9 + i], *prose(rng, 9)])) for i in range(3)]
    texts += [(50 + i, f"{stock[i]}\n{stock[i + 1]}\n{' '.join(prose(rng, 12))}") for i in range(6)]
    long = prose(rng, 900, 10**6)
    texts += [(60, " ".join(long)), (61, " ".join([*long[:-9], "y", *long[-8:]])), (62, "a b c"), (63, "z " * 60)]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t in texts if not base(t)["base_failed"]]
    left = [(i, t) for i, t in lines(left, 1).items() if t.split()]
    same = classes(left, 5, 80)
    left = [(i, t) for i, t in left if same[i][0]["component_id"] == i]
    found = hits(left, items)
    left = {i: t for i, t in left if not found[i][0]["contaminated"]}
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(model.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}

    sizes, bins = {}, {}
    for r in cp.run(spark, str(tmp_path)).collect():
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sizes == want and 20 < len(want) < len(texts) - 6
    for parts in bins.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert ends[:-1] == [o for o, _ in sorted(parts)] and ends[-1] <= 1024

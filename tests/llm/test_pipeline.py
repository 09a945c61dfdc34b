"""The pipeline's stages, one after another, and the registered queries."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import corpus_pipeline
import pytest
from llm_helpers import frame, odd_documents, words
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tapeline.llm.queries import WORD_BPE

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "jaccard_join", "mixing", "bpe"]
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_every_stage_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    schema = docs.schema
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.schema == schema
        ids, old = (Counter(r[0] for r in d.select("doc_id").collect()) for d in (docs, before))
        if i in (0, 2):
            assert not ids - old
        elif i in (1, 4):
            assert ids == old
        else:
            assert set(ids) <= set(old) and max(ids.values()) <= 2
    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for r in before.collect():
        coded = library.encode(r["text"] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, coded)).encode()).hexdigest()
        expected.append((r["doc_id"], len(coded), digest))
    assert sorted((r[0], r[1], r[2]) for r in docs.collect()) == sorted(expected)
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_odd_documents_go_through_every_stage(spark):
    docs = frame(spark, odd_documents(), clashing=True)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        assert stage(spark, docs.limit(0), SF_DIR).collect() == []
        if i < 4:
            assert out.schema == docs.schema
            docs = spark.createDataFrame(out.collect(), docs.schema)
    kept = [words(r["text"]) for r in docs.collect()]
    assert all(kept)


def test_near_copies_against_all_pairs_at_five_words(spark):
    """Scattered edits that leave five-word Jaccard on either side of 0.8; short and light sets too."""
    rng = random.Random(11)
    texts = []
    for size, most in ((200, 6), (100, 4), (60, 3), (27, 1), (18, 1), (10, 1), (6, 1)):
        for i in range(8):
            base = [f"w{size}x{i}x{j}" for j in range(size)]
            texts.append(" ".join(base))
            for edits in range(1, most + 1):
                # Evenly apart, so that every edit touches five shingles of its own.
                copy = list(base)
                for e in range(edits):
                    copy[(2 * e + 1) * size // (2 * edits)] = f"e{size}x{i}x{edits}x{e}"
                texts.append(" ".join(copy))
            # One more or fewer words at the end.
            texts += [" ".join(base[: size - 1 - i // 3]), " ".join(base + ["more"] * (i % 3))]
    rng.shuffle(texts)
    sets = []
    for t in texts:
        w = words(t)
        width = min(5, len(w))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    near = 0
    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * len(sets[i] | sets[j]):
            near += 100 * both < 83 * len(sets[i] | sets[j])
            low, high = sorted((root(i), root(j)))
            group[high] = low
    assert near > 10
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    kept = stage(spark, frame(spark, list(enumerate(texts))), SF_DIR)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({root(i) for i in range(len(texts))})


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if n.startswith("op")))
def test_queries_have_the_columns_of_their_contract(spark, name):
    columns = {
        "1": "doc_id n_words n_base first_word last_word base_labels labels score",
        "2": "doc_id size source_size target taken",
        "3": "doc_id start n_tokens ids_crc32",
        "4": "doc_id text n_lines n_removed",
        "5": "doc_id n_tokens ids_sha256 decoded_sha256",
        "6": "doc_id held_out score predicted",
        "7": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "8": "query_id rank vec_id score",
        "9": "doc_id n_shingles component_id",
        "10": "page_id url text n_chars",
        "11": "word form root n n_near form_n",
        "12": "doc_id held_out score predicted",
        "13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    }[name[2:].split("_")[0]].split()
    # More columns may follow.
    assert contract.queries()[name](spark, SF_DIR).columns[: len(columns)] == columns

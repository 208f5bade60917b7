import hashlib
import random

import public_tokenizers
import tiktoken

import corpus_fixture as fixture
import corpus_pipeline
from tracewell.llm import bpe, stages
from tracewell.llm import queries as corpus


def test_stages_and_result(spark, tmp_path):
    rng = random.Random(5)
    texts = fixture.awkward_texts(5) + [" ".join(fixture.words(rng, 40)) for _ in range(30)]
    ids = list(range(len(texts)))
    docs = fixture.documents(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept: dict = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    lettered = {i for i in ids if any(c.isalpha() for c in texts[i] or "")}
    assert set(kept["language_id"]) <= lettered and len(kept["language_id"]) >= 0.8 * len(lettered)
    assert len(kept["ngram_jaccard_join"]) < len(kept["language_id"])
    assert set(kept["source_mix"]) <= set(kept["suffix_array_dedup"]) <= set(kept["ngram_jaccard_join"])
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for row in docs.collect():
        decoded = other.decode_bytes(row.ids)
        assert hashlib.sha256(decoded).hexdigest() == row.decoded_sha256
        assert row.n_tokens == len(row.ids) and list(row.ids) == other.encode_ordinary(decoded.decode())


def test_language_id_drops_noise_and_other_scripts(spark):
    rng = random.Random(9)
    clean = [" ".join(fixture.words(rng, n)) for n in (8, 20, 60, 200, 600) for _ in range(40)]
    cyrillic, latin = "абвгдежзиклмнопрстуфхцчшщыэюя    ", "abcdefghijklmnopqrstuvwxyz     "
    junk = ["".join(rng.choice(a) for _ in range(n)) for a in (cyrillic, latin) for n in (60, 400, 3000) for _ in range(20)]
    junk += [rng.randbytes(n).hex() for n in (50, 1500) for _ in range(20)]
    docs = fixture.documents(spark, clean + junk, langs=["en"] * len(clean) + [None] * len(junk))
    kept = {r.doc_id for r in stages.language_id(spark, docs, "").select("doc_id").collect()}
    assert len(kept & set(range(len(clean)))) >= 0.97 * len(clean)
    assert len(kept - set(range(len(clean)))) <= 0.02 * len(junk)


def test_near_copies_leave_one_row_whatever_their_ids(spark):
    rng = random.Random(3)
    text, other = (" ".join(fixture.words(rng, 80)) for _ in range(2))
    near = text + " more"
    texts = [text, text, text, near, text, other, "", None, None, other, other]
    ids = [None, None, 7, 7, 8, 7, 7, None, 1, None, None]
    kept = stages.jaccard_join(spark, fixture.documents(spark, texts, ids=ids), "")
    assert kept.columns == fixture.documents(spark, []).columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got in [sorted([(7, one), (7, other), (7, ""), (None, None), (1, None)], key=repr) for one in (text, near)]
    assert stages.jaccard_join(spark, fixture.documents(spark, [text, text], ids=[None, None]), "").count() == 1


def test_stages_take_empty_tables_and_rows_without_ids(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(fixture.words(rng, 60)) for _ in range(12)]
    cases = [([], []), (texts + texts[:3], [None] * 5 + [3] * 5 + list(range(20, 25)))]
    for case, (own, ids) in enumerate(cases):
        docs = fixture.documents(spark, own, ids=ids)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").write.parquet(str(tmp_path / f"{name}{case}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{case}"))
        assert (docs.count() > 0) == bool(own)


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in corpus.QUERIES)
    assert numbers == list(range(1, 14))

"""The whole pipeline against the stages' brute-force versions, one after another."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import test_decontaminate
import test_ngram_join
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streambed.llm import toxicity

LENGTH = 100
BAD = ["wretch", "vermin", "dimwit", "grumblefool"]


def tables(spark, folder):
    rng = random.Random(11)
    bits = ["ta", "re", "mon", "li", "sho", "ver", "an", "po", "qui", "del"]
    prose = lambda n: " ".join("".join(rng.choices(bits, k=rng.randint(1, 3))) for _ in range(n))
    docs, labels = [], []
    for i in range(400):
        words = prose(rng.choice([30, 120])).split()
        if bad := i % 5 == 0:
            for k in range(0, len(words), 12):
                words[k] = rng.choice(BAD)
        docs.append((i, " ".join(words), "en", f"s{i % 3}"))
        labels.append((i, 1, int(bad)))
    items = [(k, prose(20)) for k in range(6)]
    notice = prose(60)
    for i in range(40):
        base = docs[4 * i + 1][1]
        docs.append((400 + i, base if i % 2 else base + " tail", "en", "copy"))
        docs.append((500 + i, f"{prose(40)} {notice} {prose(30)}", "en", "notice"))
        docs.append((600 + i, f"{prose(10)} {items[i % 6][1]} {prose(40)}", "en", "leak"))
    docs += [(900, None, None, None), (901, "", "en", "s"), (902, notice, "en", "s")]
    docs = [(d, t, lang, s, len(t or "")) for d, t, lang, s in docs]
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return docs, items


def without_repeats(rows):
    """Texts less every byte of a 100-byte string that starts earlier."""
    seen, out = {}, []
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - LENGTH + 1):
            string = data[i:i + LENGTH]
            gone[i:i + LENGTH] |= seen.setdefault(string, (doc, i)) != (doc, i)
        left = np.frombuffer(data, np.uint8)[~gone].tobytes().decode(errors="ignore")
        if left or not gone.any():
            out.append((doc, left if text is not None else None))
    return out


def test_pipeline_matches_brute_force(spark, tmp_path):
    docs, items = tables(spark, str(tmp_path))
    rows = [(d, t) for d, t, *_ in docs]
    model = toxicity.fit_toxicity(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = {}
    for doc, text in rows:  # one text at a time instead of runs of a batch
        hits, windows = toxicity.count_hits(toxicity.Distance(model.ordinary, model.toxic), *toxicity._joined([text or ""]))
        scores[doc] = model.scores(hits, windows)[0]
    clean = [(d, t) for d, t in rows if scores[d] < 0.7]
    assert 300 < len(clean) < len(rows) - 60
    alone = {d for d, _, c in test_ngram_join.brute(clean) if d == c}
    kept = without_repeats([r for r in clean if r[0] in alone])
    verdict = {r[0]: r[5] for r in test_decontaminate.brute(kept, items)}
    kept = [(d, t) for d, t in kept if not verdict[d]]
    assert 0 < sum(verdict.values()) and not {902} & {d for d, _ in kept} and {900, 901} <= {d for d, _ in kept}
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in kept}
    got = corpus_pipeline.run(spark, str(tmp_path))
    sums = {r.doc_id: (r.n, r.doc_tokens) for r in got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("doc_tokens")).collect()}
    assert sums == {d: (n, n) for d, n in want.items()}
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").isEmpty()


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).dtypes == docs.dtypes

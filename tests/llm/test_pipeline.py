"""The pipeline's stages, each on its own input, against plain versions of their rules."""

import collections
import re
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from pickwise.llm import quality_rules, toxicity
from pickwise.llm.common import written
from pickwise.llm.queries import CATEGORIES, toxicity_labels, trusted_ids

from .test_operators import BPE, WORDS, _gram_scores

SF = "/root/testdata/sf0.001"


def base_failed(text):
    w = WORDS.findall(text or "")
    c = collections.Counter(zip(w, w[1:], w[2:]))
    marked = {p for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    return len(w) < 50 or 100 * len(marked) > 50 * len(w)


def five_words(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_kept(rows):
    sets = [five_words(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    return sorted(min(r[0] for r, c in zip(rows, comp) if c == k) for k in set(comp))


def plain_stage(spark, name, sent):
    """Identifiers that the stage has to keep of ``sent``."""
    rows = [(r.doc_id, r.text) for r in sent.collect()]
    if name == "quality_rules":
        trusted = {r.doc_id for r in trusted_ids(spark, SF).collect()}
        scores = _gram_scores(rows, trusted)
        close = {i for (i, _), s in zip(rows, scores) if abs(s - quality_rules.THRESHOLD) < 1e-4}
        assert not close
        return sorted(i for (i, t), s in zip(rows, scores) if not base_failed(t) and s >= quality_rules.THRESHOLD)
    if name == "toxicity":
        chain = toxicity.fit(sent, toxicity_labels(spark, SF), CATEGORIES)
        p = chain.probabilities([toxicity.feature_ids(t) for _, t in rows])[:, -1]
        return sorted(i for (i, _), x in zip(rows, p) if x < chain.threshold)
    if name == "exact_dedup":
        last = {}
        for i, t in sorted(rows):
            last[t or ""] = i
        return sorted(last.values())
    return near_kept(rows)


def test_stages_equal_their_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sent = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, sent, SF), "test-stage")
        assert kept.columns == columns and kept.exceptAll(sent).count() == 0, name
        assert sorted(r.doc_id for r in kept.collect()) == plain_stage(spark, name, sent), name
        assert kept.count() > 0
        sent = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, sent, SF).collect()
    from tokenizers import Tokenizer
    tokenizer, want = Tokenizer.from_file(BPE), collections.Counter()
    for r in sent.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        for n in range(0, len(ids), 4096):
            want[r.doc_id, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[n:n + 4096]))] += 1
    assert collections.Counter((r.doc_id, r.start, r.ids_crc32) for r in packed) == want
    used = collections.Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_stages_on_odd_rows(spark, table):
    """Null and empty texts, null and repeated identifiers, clashing columns; and no rows at all."""
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = given.limit(3).withColumn("doc_id", F.lit(None).cast("long")).unionByName(given.limit(3)).unionByName(
        given.limit(2).withColumn("text", F.lit(None).cast("string"))).unionByName(given.limit(2).withColumn("text", F.lit("")))
    sent = given.unionByName(odd).withColumn("kept", F.lit("x")).withColumn("p_toxic", F.lit(1)).withColumn("row", F.lit(2))
    sent = written(sent if table == "odd" else sent.limit(0), "test-odd")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, sent, SF), "test-stage")
        assert kept.columns == sent.columns and kept.count() <= sent.count()
        sent = kept
    assert sent.where("text is null or text = ''").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, sent, SF)
    assert packed.select("doc_id").distinct().count() <= sent.count() and (table == "odd") == (packed.count() > 0)

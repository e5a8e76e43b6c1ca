"""The pipeline as a whole against brute force: near copies by all Jaccard similarities, leaks by edit distance, places in the mix, shards."""

import corpus_pipeline
from tests.llm.test_language_brute import Plain
from tests.llm.test_mix_plan import brute_positions
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_text_scans import edit_distance_within
from tidelog.llm import decontaminate, language_id, mixing, sharding


def leaky(words, items):
    """Whether some item is within a fifth of its words; items that share too few of their words are passed over, which loses none."""
    have = set(words)
    for item in items:
        if sum(w in have for w in item) >= len(item) - len(item) // 5 and edit_distance_within(item, words) <= len(item) // 5:
            return True
    return False


def test_every_stage(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in docs.collect()}
    # language: the cross-entropies are those of plain models; the limits are the calibrated ones
    train = [r for k, r in rows.items() if r.lang is not None and len(language_id.symbols(r.text))]
    train = [r for r in train if r.doc_id in {x.doc_id for x in docs.where(~language_id.held_out()).select("doc_id").collect()}]
    model = language_id.train_on(docs)
    alphabet = len({c for r in train for c in language_id.symbols(r.text).tolist()} | {32}) + 1
    plain = [Plain([r.text for r in train if r.lang == name], alphabet) for name in model.languages]
    import math

    def accepted(text):
        own = language_id.symbols(text).tolist()
        if not own:
            return False
        line = [32, 32, 32, *own, 32]
        cross = [-sum(math.log(p.probability(tuple(line[i : i + 4]))) for i in range(len(own) + 1)) / (len(own) + 1) for p in plain]
        best = cross.index(min(cross))
        return cross[best] <= model.limits[best] + language_id.SYMBOL_SPREAD / math.sqrt(len(own))

    want = [k for k, r in sorted(rows.items()) if accepted(r.text)]
    want = brute_kept([(k, rows[k].text) for k in want])
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = [k for k in want if not leaky(decontaminate.words_of(rows[k].text), items)]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert sorted(found) == want
    places = brute_positions([(k, rows[k].source) for k in want], mixing.BLOCK_ROWS)
    assert {k: r.mix_position for k, r in found.items()} == {k: places[k, rows[k].source][1] for k in want}
    total = sum(len((rows[k].text or "").encode()) for k in want)
    assert total <= sharding.LIMIT_BYTES and {(r.shard_depth, r.shard_rows, r.shard_bytes) for r in found.values()} == {(0, len(want), total)}

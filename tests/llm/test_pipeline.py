"""The pipeline against the plain versions of its stages."""

import numpy as np
import pytest

from quire.llm import queries

from . import brute
from .test_operators import ITEMS, frame, prose, rows_of, sample, tokenizer

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def resemblance(rows):
    """Like brute.simhash, for sets of five-word shingles and a similarity of 0.8: doc_id, size and the component's smallest doc_id."""
    sets = {}
    for doc, text in rows:
        w = brute.WORD.findall(brute.lower(text or ""))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {doc: doc for doc in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {doc: low if r == high else r for doc, r in root.items()}
    return [(doc, len(sets[doc]), root[doc]) for doc, _ in rows]


def plain(rows, items):
    """Stage by stage; no line of this small table is over a limit."""
    failed = {r[0] for r in brute.base_quality(rows) if r[6]}
    rows = [r for r in rows if r[0] not in failed]
    rows = [r for r, m in zip(rows, resemblance(rows), strict=True) if m[2] == m[0]]
    gone = {r[0] for r in brute.contamination(rows, items) if r[5]}
    rows = [r for r in rows if r[0] not in gone]
    library, out = tokenizer("word_bpe_49k.json"), []
    for (doc, text), found in zip(rows, brute.secrets(rows), strict=True):
        spans = sorted((int(a), int(b)) for _, a, b in (s.split(":") for s in found[5].split(",") if s))
        clean, at = "", 0
        for a, b in spans:
            if a >= at:
                clean += text[at:a] + "[SECRET]"
            at = max(at, b)
        ids = library.encode(clean + text[at:], add_special_tokens=False).ids
        out.append((doc, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    return sorted(out)


def test_pipeline(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows = [*sample(), (500, prose(rng, 60) + " api_key = ABCDEFGHIJKLMNOP aadeadbeefdeadbeef00 end " + prose(rng, 30)), (501, prose(rng, 20) + " " + ITEMS[0][1])]
    frame(spark, rows).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = rows_of(corpus_pipeline.run(spark, f"file://{tmp_path}"))
    assert got == plain(rows, ITEMS)
    assert 500 in {r[0] for r in got} and 501 not in {r[0] for r in got}


def test_stages_keep_the_columns(spark, tmp_path):
    docs = frame(spark, sample())
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, f"file://{tmp_path}").dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), f"file://{tmp_path}").count() == 0


def test_near_dedup_takes_texts_of_similarity_from_0_8(spark, tmp_path):
    """Against all pairs: groups of edited copies, on both sides of 0.8."""
    import random

    rng = random.Random(12)
    rows = [(1000, ""), (1001, None)]
    for g in range(40):
        base = prose(rng, rng.choice([60, 150, 400])).split()
        rows.append((10 * g, " ".join(base)))
        for k in range(1, 5):
            text = list(base)
            for at in rng.sample(range(len(text)), max(1, len(text) * k // 100)):
                text[at] = f"w{rng.random()}"
            rows.append((10 * g + k, " ".join(text)))
    root = {r[0]: r[2] for r in resemblance(rows)}
    assert len({d for d in root if root[d] != d}) > 40 and len(set(root.values())) > 45
    kept = corpus_pipeline.near_dedup(spark, frame(spark, rows), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root.values()))


def test_registered():
    assert "pipeline" in queries.queries()


def test_sketches_keep_similar_sets():
    """Sets of similarity 0.8 agree in their sketches but for a few in thousands; those of 0.6 mostly don't."""
    import numpy as np

    from quire.llm import resemblance

    rng = np.random.default_rng(3)

    def share(similarity, size, n=400):
        kept = 0
        for _ in range(n):
            common = -int(-2 * similarity * size // (1 + similarity))
            own = rng.integers(0, 1 << 64, 2 * size - common, dtype=np.uint64)
            pair = [np.sort(own[:size]), np.sort(own[size - common :])]
            made = resemblance.sketches(np.concatenate(pair), np.array([0, size, 2 * size]))
            kept += bool(resemblance.alike(made[0], made[1:])[0])
        return kept / n

    for size in (6, 40, 150, 3000):
        assert share(0.8, size) >= 0.995 and share(1.0, size) == 1
    assert share(0.6, 150) < 0.1 and share(0.6, 3000) < 0.1
    empty = resemblance.sketches(np.zeros(0, np.uint64), np.array([0, 0, 0]))
    assert resemblance.alike(empty[0], empty[1:])[0]

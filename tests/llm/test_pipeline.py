"""run() against plain Python counterparts of its stages, on the smallest tables."""

import os
import zlib

import numpy as np
import pytest

pytest.importorskip("accordant.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from test_operators import WORD, brute_scores, brute_secrets, shingles  # noqa: E402

from accordant.llm import quality_rules, secret_scans  # noqa: E402

SF = TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def good(rows, trusted):
    """Rows (id, text) that the base rules and the likelihood ratio keep."""
    scores, out = brute_scores(rows, trusted), []
    for i, t in rows:
        w = WORD.findall(t or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        often = {g for g in set(grams) if grams.count(g) > 1}
        covered = {k + x for k, g in enumerate(grams) if g in often for x in range(3)}
        if len(w) >= 50 and 100 * len(covered) <= 50 * len(w) and scores[i] >= quality_rules.THRESHOLD:
            out.append((i, t))
    return out


def one_of_each(rows):
    """The row of the least id of every component of linked sets."""
    sets = {i: shingles(t) for i, t in rows}
    group = {i: {i} for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and group[i] is not group[j]:
                both = group[i] | group[j]
                group |= dict.fromkeys(both, both)
    return [(i, t) for i, t in rows if i == min(group[i])]


def without_passages(rows):
    """Texts without the words of windows that start in a lesser document; those that lose all are gone."""
    words, first, out = {i: WORD.findall(t or "") for i, t in rows}, {}, []
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    for i, t in rows:
        gone = {k + x for k in range(len(words[i]) - 12) if first[tuple(words[i][k : k + 13])] < i for x in range(13)}
        if not gone:
            out.append((i, t))
        elif len(gone) < len(words[i]):
            out.append((i, " ".join(w for k, w in enumerate(words[i]) if k not in gone)))
    return out


def masked(rows):
    out = []
    for (i, t), spans in zip(rows, brute_secrets([t or "" for _, t in rows])):
        hidden = sorted({k for _, a, b in spans for k in range(a, b)})
        starts = {a for _, a, b in spans if not any(x < a < y or x == a and y > b for _, x, y in spans)}
        cover = set(hidden)
        out.append((i, "".join((secret_scans.MARK if k in starts else "") + ("" if k in cover else c) for k, c in enumerate(t)) if spans else t))
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_run_against_plain_counterparts(spark, tmp_path):
    tokenizers, P = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    SF = str(tmp_path)  # the tables, and documents that hold parts of others and secrets
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    long = [r for r in docs.where("lang = 'en'").orderBy("doc_id").collect() if len((r.text or "").split()) >= 150][:16]
    more = [(10**9 + i, " ".join([*x.text.split()[:60], "password: hunter22secret", *y.text.split()[-60:]]), "en", "s", 0) for i, (x, y) in enumerate(zip(long[::2], long[1::2]))]
    docs.select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame(more, docs.select(*corpus_pipeline.COLUMNS).schema)).write.parquet(f"{SF}/documents.parquet")
    labels.write.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    wanted = [good(rows, trusted)]
    for stage in (one_of_each, without_passages, masked):
        wanted.append(stage(wanted[-1]))
    assert len(rows) > len(wanted[0]) > len(wanted[1]) and wanted[2] != wanted[1] and wanted[3] != wanted[2]
    for (name, stage), own in zip(corpus_pipeline.STAGES, wanted):
        after = stage(spark, docs, SF)
        assert after.columns == corpus_pipeline.COLUMNS, name
        got = after.collect()
        assert sorted((r.doc_id, r.text) for r in got) == own, name
        docs = spark.createDataFrame(got, after.schema)
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in wanted[-1]}
    pieces, bins = corpus_pipeline.run(spark, SF).collect(), {}
    at = dict.fromkeys(ids, 0)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.piece)):
        own = np.array(ids[r.doc_id][at[r.doc_id] : at[r.doc_id] + r.length], dtype="<u4").tobytes()
        assert (r.start, r.ids_crc32, bytes(r.ids)) == (at[r.doc_id], zlib.crc32(own), own)
        at[r.doc_id] += r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {i: len(x) for i, x in ids.items()}
    for own in bins.values():
        assert [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_trusted_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0")
    trusted = {r.doc_id for r in docs.join(labels, "doc_id", "left_semi").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    assert trusted & {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 50} <= kept


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_without_ids_and_extra_cases(spark):
    rows = [(None, "alone " * 3, "en", "s", 18), (1, "a b", None, None, None), (2, "a b", "en", "s", 3), (2, "a b", "en", "s", 3), (4, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == [0, 1, 4]
    assert corpus_pipeline.repeated_passages(spark, docs, SF).count() == 5
    assert [r.text for r in corpus_pipeline.secrets(spark, docs, SF).orderBy("doc_id").collect()] == [r[1] for r in sorted(rows, key=lambda r: r[0] or 0)]

"""The filter audit against a plain second implementation and over several micro-batches."""

import itertools
import os
import random
import re

import pandas as pd
import pytest

from brevia.llm import filter_audit as fa

LABELS = "doc_id bigint, quality int, toxic int, lang string"


def fails(text, doc_id, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = "A" if len(words) < 100 else ""
    found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    found += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
    found += "D" if re.search(r"[#$%&*|]", text) else ""
    return found + ("E" if doc_id is not None and smaller else "")


def expected(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[k] == 1} for k in (1, 2))
    docs = [(p or "", fails(t or "", i, i is not None and first[t or ""] < i), i) for i, t, p in rows]
    out, alone = {}, {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                gone_ids = {id(d) for d in gone}
                failing = [d for d in own if f in d[1]]
                left = [d for d in left if id(d) not in gone_ids]
                alone[part, f] = alone.get((part, f), 0) + len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(any(e in d[1] for e in order[: step - 1]) for d in failing),
                    sum(d[1] == f for d in own), sum(d[2] in good for d in gone), sum(d[2] in toxic for d in gone),
                ]
    return {k: (*v, alone[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def rows(seed=4, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefXYé") for _ in range(rng.randint(1, 5)))
    texts = [" ".join(word() for _ in range(rng.choice([3, 90, 130, 200]))) for _ in range(40)]
    texts += [" ".join(["same", "words"] * 60), "1 $ 2", "A" * 500, "中文 " * 120, "", None, "x y " * 20_000]
    out = [(rng.randrange(10_000), rng.choice(texts), rng.choice(["en", "fr", None, ""])) for _ in range(n)]
    out += [(None, texts[0], "en"), (None, texts[0], "en"), (7, texts[0], "fr"), (7, texts[0], "fr"), (7, texts[0], "en")]
    out += [(7, texts[1], "en"), (-5, texts[2], "en"), ((1 << 60) + 1, texts[3], "en"), ((1 << 60) + 2, texts[3], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "zz") for i, _, _ in rng.sample(out, 90)]
    return out, labels + [(7, 1, 0, "zz"), (7, 0, 1, "zz"), (None, 1, 1, "zz")]


def folder_of(spark, tmp_path, parts):
    """A folder with one file for each list of rows; ``mask`` and ``n`` clash with ours."""
    path = str(tmp_path / "documents.parquet")
    for part in parts:
        data = [(i, t, p, "m", "n") for i, t, p in part]
        frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string, mask string, n string")
        frame.coalesce(1).write.mode("append").parquet(path)
    return path


def figures(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in df.collect()}


@pytest.mark.parametrize("descending", [False, True])
def test_every_order_and_step(spark, tmp_path, descending):
    docs, labels = rows()
    # with ids descending every file brings smaller ids, so masks are retracted
    ordered = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0), reverse=descending)
    path = folder_of(spark, tmp_path, [ordered[k::5] if not descending else ordered[k * 34 : k * 34 + 34] for k in range(5)])
    audit = fa.FilterAudit(spark, path, spark.createDataFrame(labels, LABELS), batches=3, keys=3)
    assert figures(audit.report()) == expected(docs, labels)


def test_new_files_go_on_from_the_state(spark, tmp_path):
    docs, labels = rows(9)
    labelled = spark.createDataFrame(labels, LABELS)
    kept = {"folder": str(tmp_path / "audit"), "keys": 5}
    path = folder_of(spark, tmp_path, [docs[:80]])
    assert figures(fa.FilterAudit(spark, path, labelled, **kept).report()) == expected(docs[:80], labels)
    folder_of(spark, tmp_path, [docs[80:]])
    assert figures(fa.FilterAudit(spark, path, labelled, **kept).report()) == expected(docs, labels)
    progress = os.listdir(tmp_path / "audit" / "changes")
    assert len([p for p in progress if p.startswith("batch=")]) >= 2


def test_a_smaller_id_retracts():
    def frame(*ids):
        cells = [(1, 2, i, "en", 1, 0, 0, 1) for i in ids]
        return pd.DataFrame(cells, columns=["k1", "k2", "doc_id", "part", "mask", "good", "toxic", "n"])

    state, changes = fa.merged(frame().astype("int64"), frame(9, 9, 12))
    assert state[["doc_id", "n"]].values.tolist() == [[9, 2]]
    assert dict(zip(changes["mask"], changes["n"])) == {1: 2, 17: 1}
    state, changes = fa.merged(state, frame(4))
    assert state[["doc_id", "n"]].values.tolist() == [[4, 1]]
    assert dict(zip(changes["mask"], changes["n"])) == {1: -1, 17: 2}


def test_empty_tables(spark, tmp_path):
    path = folder_of(spark, tmp_path, [[]])
    none = spark.createDataFrame([], LABELS)
    assert fa.FilterAudit(spark, path, none).report().count() == 0


import itertools
import math
import random
from collections import Counter

import pyarrow as pa

import corpus_pipeline
from voltloom.llm import decontam, licenses, minmax, mixing, secret_scan, urls

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


# -- source mix in the pipeline --------------------------------------------------------------------

def test_pipeline_mix_takes_what_the_labelled_mix_takes(spark, tmp_path):
    rng = random.Random(21)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 40))), "en", f"s{i % 3}", 0) for i in range(900)]
    rows += [(None, "no id here", "en", "s1", 0), (7, "an id twice", "en", None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(900) if i % 5] + [(3, 0, 0), (None, 1, 0)], LABELS)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    size = {r["doc_id"]: 0 for r in docs.collect()}
    want, plain = Counter(size), Counter(size)
    for out, lab in ((want, labels), (plain, None)):
        for r in mixing.mix(docs, lab).collect():
            out[r["doc_id"]] += r["taken"]
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns
    got = Counter(size)
    for r in mixed.collect():
        got[r["doc_id"]] += len(r["text"].split())
    assert got == want
    assert want != plain


# -- near duplicates with repeated rows ------------------------------------------------------------

def test_repeated_rows_keep_their_links(spark, monkeypatch):
    """Texts apart from the leader that are linked through words outside it, every row two to ten times."""
    def one_bucket(batches):  # all texts with the same first word, and no others, share a bucket
        for b in batches:
            sets = [minmax.shingle_set(t.as_py(), minmax._WordHashes()) for t in b.column("text")]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text_hash": b.column("text_hash"), "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                                   "set_print": pa.array([x.tobytes() for x in sets], pa.binary()), "bands": pa.array([[int(t.as_py().split()[0])] for t in b.column("text")], pa.list_(pa.int64()))})

    rng, texts, rows = random.Random(31), {}, []
    fresh = lambda n: [f"w{rng.getrandbits(48)}" for _ in range(n)]
    for c in range(12):
        core = [str(c), *fresh(70)]
        group = [core + fresh(25) for _ in range(4)]
        for _ in range(3):
            more = core + fresh(20)
            group += [more + fresh(10) for _ in range(3)]
        rng.shuffle(group)
        texts |= {len(texts) + i: " ".join(ws) for i, ws in enumerate(group)}
    for i, t in texts.items():
        rows += [(i, t)] * rng.randint(2, 10)
    rng.shuffle(rows)

    sets = {i: set(minmax.shingle_set(t, minmax._WordHashes()).tolist()) for i, t in texts.items()}
    want = {i: i for i in texts}
    for i in sorted(texts):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                want[i] = min(want[i], want[j])
    assert len(set(want.values())) == 12 * (4 + 3)
    monkeypatch.setattr(minmax, "_sign", one_bucket)
    got = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "component_id").collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want


# -- decontamination masks -------------------------------------------------------------------------

def test_no_accepted_stretch_is_without_a_seed():
    for n in range(1, decontam.WINDOW + 1):
        masks = decontam.MASKS if n == decontam.WINDOW else decontam.SHORT_MASKS[n]
        seeds = [{s + o for o in decontam._ones(m)} for m in masks for s in range(n - len(m) + 1)]
        for changed in itertools.combinations(range(n), n - math.ceil(n * decontam.SHARE)):
            assert any(not seed & set(changed) for seed in seeds), (n, changed)


def test_all_accepted_substitutions_are_found(spark):
    rows, items, want = [], [], set()
    for n in (1, 4, 5, 7, 9, 10, 11, 12, 13, 15, 16):
        item = [f"q{n}x{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        w = min(n, decontam.WINDOW)
        for k in (w - math.ceil(w * decontam.SHARE), w - math.ceil(w * decontam.SHARE) + 1):
            for changed in itertools.combinations(range(n), k):
                part = ["z" if i in changed else x for i, x in enumerate(item)]
                if max(sum(x != "z" for x in part[s:s + w]) for s in range(n - w + 1)) >= math.ceil(w * decontam.SHARE):
                    want.add((len(rows), n))
                rows.append((len(rows), "a b c " + " ".join(part) + " d e"))
    found = decontam.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.select("doc_id", "item_id").collect()} == want


# -- licence notices -------------------------------------------------------------------------------

def test_every_rule_fires_on_its_notice(spark):
    texts, want = [], []
    for name, kind, rules, _ in licenses.RULES:
        for rule in rules:
            texts.append("Header\n\n" + "; ".join(licenses.SENTENCES[k] for k in rule) + ".\nmore")
            want.append(([name], kind))
    mpl = (" * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
           " * file, You can obtain one at https://mozilla.org/MPL/2.0/.")
    texts += [mpl, mpl.replace("License, v. 2.0", "License, v.\n * 2.0")]
    want += [(["MPL-2.0"], "copyleft")] * 2
    got = {r["doc_id"]: (r["licenses"], r["license_class"]) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [got.get(i, ([], None)) for i in range(len(texts))] == want


# -- decontamination without ids -------------------------------------------------------------------

def test_rows_and_items_without_an_id(spark):
    leak = " ".join(f"q{i}" for i in range(20))
    rows = [(None, "clean one"), (None, f"a {leak} b"), (1, "clean two"), (1, leak), (2, "clean three"), (2, "clean three"), (3, " ".join(f"r{i}" for i in range(15))), (4, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(9, leak), (None, " ".join(f"r{i}" for i in range(15))), (None, None)], "item_id bigint, text string")
    left = [tuple(r) for r in decontam.decontaminate(docs, items).collect()]
    assert Counter(left) == Counter([rows[0], rows[2], rows[4], rows[5], rows[7], rows[8]])
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()} == {(None, 9), (1, 9), (3, None)}


# -- URL filters -----------------------------------------------------------------------------------

def test_path_patterns_keep_their_case(spark):
    entries = spark.createDataFrame([("own", "OK.example/Ads/", "add", "2024-01-01"), ("own", "Bad.Example", "add", "2024-01-01")], "list string, pattern string, action string, dated string")
    rows = [(1, "http://ok.Example/Ads/x", "2024-05-01"), (2, "http://ok.example/ads/x", "2024-05-01"), (3, "http://www.bad.example/X", "2024-05-01")]
    out = urls.evaluate(spark.createDataFrame(rows, "page_id bigint, url string, fetched string"), entries).collect()
    assert {r["page_id"] for r in out if r["blocked"]} == {1, 3}


# -- secrets ---------------------------------------------------------------------------------------

def test_parts_of_a_scope_are_linked_at_any_distance(spark):
    far, key = "client_id: app-17\n" + "filler words\n" * 40, "key " + "Ab3" * 10
    df = spark.createDataFrame([(1, far + key), (2, far + "\n" + key)], "doc_id bigint, text string")
    got = {r["doc_id"]: [secret_scan.KINDS[s["kind"]] for s in r["linked"]] for r in secret_scan.scan(df).collect()}
    assert got == {1: ["ident", "opaque"], 2: []}

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import frame, prose, words

from ballotlens.llm import boosting, pii, toxicity
from ballotlens.llm import decontaminate as D
from ballotlens.llm import licenses as L
from ballotlens.llm.decontaminate import contaminated
from ballotlens.llm.suffix_dedup import cut_spans, repeated_passages


# ---------------------------------------------------------------- toxicity
def toxic_rows(n=240, seed=1):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        w, y = prose(rng, rng.randint(5, 150)).split(), int(rng.random() < 0.4)
        if y:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), "GRUM" + prose(rng, 1))
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    return rows, labels


def test_gradients_agree_with_differences():
    texts = ["grumba de ki", "lo mu na grumso ri", "pe ri so tu", ""]
    table, numbers, bounds = toxicity._tokens(pa.array(texts * 3))
    net = toxicity.Network(toxicity._vocabulary(table, numbers, bounds), 3)
    windows, _ = toxicity._windows(numbers, bounds)
    windows = windows[:4]
    inputs = net.inputs(net.rows(table)).astype(np.float64)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    weight = np.array([1.0, -0.5, 2.0, 0.3])
    value = lambda: float((net.forward(net.gates(inputs), windows) * weight).sum())
    _, state = net.forward(net.gates(inputs), windows, keep=True)
    grads, d_inputs = net.backward(weight, windows, inputs, state)
    rng = np.random.default_rng(0)
    for name, w, g in [*((k, net.p[k], grads[k]) for k in net.p), ("inputs", inputs, d_inputs)]:
        for _ in range(4):
            i = tuple(rng.integers(s) for s in w.shape)
            old, step = w[i], 1e-3
            w[i] = old + step
            up = value()
            w[i] = old - step
            slope, w[i] = (up - value()) / (2 * step), old
            assert slope == pytest.approx(g[i], rel=0.05, abs=2e-3), name


def test_held_out_accuracy_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 150)
    rows, labels = toxic_rows()
    rows += [(900, None), (901, ""), (None, "no id"), (902, prose(random.Random(2), 20000) + " grumba"), (3, rows[3][1])]
    marks = spark.createDataFrame([(i, 1, y) for i, y in labels] + [(900, 1, None), (None, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(frame(spark, rows), marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    import zlib
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 25 and np.mean([p == y for p, y in held]) >= 0.9
    kept = toxicity.without_toxic(frame(spark, rows), marks)
    assert kept.columns == frame(spark, rows).columns
    by_text = {(r.doc_id, r.predicted) for r in got}
    assert {(r.doc_id, 0) for r in kept.collect()} <= by_text


def test_without_labels_of_both_classes(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    marks = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity_scores(docs, marks.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity_scores(docs.limit(0), marks.limit(0)).count() == 0
    assert toxicity.without_toxic(docs, marks.limit(0)).count() == 2


# ---------------------------------------------------------------- repeated passages
def brute_spans(rows, n=50):
    held, texts = {}, {}
    for i, t in rows:
        if i is None:
            continue
        texts.setdefault(i, []).append(words(t))
    for i, many in texts.items():
        for w in many:
            for k in range(len(w) - n + 1):
                held.setdefault(tuple(w[k:k + n]), set()).add(i)
    cover = {}
    for i, many in texts.items():
        for w in many:
            for k in range(len(w) - n + 1):
                if len(held[tuple(w[k:k + n])]) > 1:
                    cover.setdefault(i, set()).update(range(k, k + n))
    return cover


def test_passages_equal_brute_force(spark):
    rng = random.Random(8)
    shared = [prose(rng, n) for n in (49, 50, 51, 64, 120, 900)]
    rows = [(i, prose(rng, rng.randint(0, 300))) for i in range(60)]
    for k in range(40):
        parts = [prose(rng, rng.randint(0, 40)), rng.choice(shared).upper(), prose(rng, rng.randint(1, 40)), rng.choice(shared)]
        rows.append((100 + k, "\n".join(parts)))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, ""), (None, shared[4]), (None, shared[4]), (0, rows[0][1]),
             (204, prose(rng, 20000) + " " + shared[3])]
    found = repeated_passages(frame(spark, rows)).collect()
    got = {}
    for r in found:
        assert r.n_words == r.end_word - r.start_word >= 50 and r.first == (r.least_doc_id == r.doc_id)
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert got == brute_spans(rows)
    assert repeated_passages(frame(spark, [])).count() == 0
    assert repeated_passages(frame(spark, [(1, shared[5]), (1, shared[5]), (2, "a b")])).count() == 0


def test_passages_that_a_document_repeats_itself(spark):
    rng = random.Random(31)
    passage, longer = prose(rng, 52), prose(rng, 90)
    often = " ".join(f"{prose(rng, 30)} {passage}" for _ in range(25))
    rows = [(1, often), (2, f"{prose(rng, 40)} {passage} {prose(rng, 40)}"), (3, prose(rng, 200)),
            (4, " ".join(f"{prose(rng, 7)} {longer}" for _ in range(12))), (5, prose(rng, 9) + " " + longer),
            (6, " ".join(f"{longer[:300]} {prose(rng, 3)}" for _ in range(9))),
            (7, " ".join(f"{prose(rng, 5)} {passage.rsplit(' ', 3)[0]}" for _ in range(9)))]
    got = {}
    for r in repeated_passages(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    want = brute_spans(rows)
    assert got == want and len(want[1]) == 25 * 52 and 7 not in want


def test_cut_spans():
    assert cut_spans("a bé c d", [(1, 3)]).split() == ["a", "d"] and cut_spans("a b", []) == "a b"


# ---------------------------------------------------------------- decontamination
def windows_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def similarity(a, b):
    from collections import Counter
    x, y = (Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(11)
    items = [(k, prose(rng, n)) for k, n in enumerate((5, 14, 30, 30, 59, 59, 4, 0))] + [(8, None), (9, "one two " * 20)]
    rows = [(i, prose(rng, rng.randint(0, 80))) for i in range(40)]
    for k in range(60):
        w = rng.choice(items[:6])[1].split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        if rng.random() < 0.3:
            w.insert(rng.randrange(len(w)), "zz")
        rows.append((100 + k, prose(rng, rng.randint(0, 50)) + ". " + " ".join(w).title() + "! " + prose(rng, rng.randint(0, 50))))
    rows += [(200, None), (201, ""), (202, "one two " * 25), (203, items[4][1][:120]), (101, rows[41][1]),
             (204, prose(rng, 20000) + " " + items[4][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, key string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(frame(spark, rows), bench).collect()}
    want = {}
    for i, t in rows:
        w = windows_of(t)
        for k, item in items:
            v = windows_of(item)
            if len(v) >= 5 and len(w) >= 5:
                best = max(similarity(w[a:a + len(v)], v) for a in range(max(1, len(w) - len(v) + 1)))
                if best >= 0.8:
                    want[i, k] = max(best, want.get((i, k), 0))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert contaminated(frame(spark, []), bench).count() == 0
    assert contaminated(frame(spark, rows), bench.limit(0)).count() == 0


def best_windows(rows, items, least=0.8):
    want = {}
    for i, t in rows:
        w = windows_of(t)
        for k, item in items:
            v = windows_of(item)
            best = max(similarity(w[a:a + len(v)], v) for a in range(max(1, len(w) - len(v) + 1)))
            if best >= least:
                want[i, k] = best
    return want


def test_decontamination_of_trimmed_items_with_insertions(spark):
    rng = random.Random(17)
    items = [(k, prose(rng, n)) for k, n in enumerate((59, 59, 120, 200))]
    rows = []
    for k in range(60):
        w = rng.choice(items)[1].split()
        cut = rng.randint(0, len(w) // 25)
        w = w[cut:len(w) - rng.randint(0, len(w) // 25)]
        half = len(w) // 2
        w[half:half] = prose(rng, rng.randint(0, len(w) // 15)).split()
        rows.append((k, f"{prose(rng, rng.randint(0, 40))} {' '.join(w)} {prose(rng, rng.randint(0, 40))}"))
    whole = items[3][1].split()
    rows += [(100, " ".join(whole[7:100] + prose(rng, 13).split() + whole[100:193]))]
    rows[-1] = (100, f"{prose(rng, 30)} {rows[-1][1]} {prose(rng, 30)}")
    short = items[0][1].split()
    rows += [(101, f"{prose(rng, 9)} {' '.join(short[1:30] + prose(rng, 2).split() + short[30:58])} {prose(rng, 9)}")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(frame(spark, rows), bench).collect()}
    want = best_windows(rows, items)
    assert got.keys() == want.keys() and {(100, 3), (101, 0)} <= want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_decontamination_of_items_with_repeated_words(spark):
    rng = random.Random(23)
    items = [(k, prose(rng, 200)) for k in range(20)]
    rows = []
    for k, item in items:
        w = item.split()
        rows.append((k, " ".join(w[:184] + [prose(rng, 1)] * 16)))
        rows.append((100 + k, f"{prose(rng, 20)} {' '.join(w[:90] + ['zu'] * 12 + w[102:])} {prose(rng, 20)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(frame(spark, rows), bench).collect()}
    want = best_windows(rows, items)
    assert got.keys() == want.keys() and len(want) == 40
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_index_lets_few_unrelated_pairs_meet(spark):
    """Half of the items begin with the same sentence, and every window holds it too."""
    rng = random.Random(29)
    shared = prose(rng, 12)
    items = [(k, f"{shared if k % 2 else prose(rng, 12)} {prose(rng, 28)}") for k in range(120)]
    texts = [(k, " ".join([*t.split()[:38], "zu", "zu"])) for k, t in items] + [(200 + k, f"{shared} {prose(rng, 28)}") for k in range(60)]
    def side(rows, key):
        df = spark.createDataFrame(rows, f"{key} long, t string").select(key, D.words(D.F.col("t")).alias("w"))
        df = df.select(key, D.F.size("w").alias("n"), D.numbered(D.shingle_hashes(D.F.col("w"))).alias("votes"))
        return df.withColumn(f"{key}_print", D.simhash(D.F.col("votes")))
    met = {(r.window, r.item) for r in D.meeting(side(texts, "window"), side(items, "item"), 0.8).distinct().collect()}
    alike = {(i, k) for i, t in texts for k, v in items if similarity(windows_of(t), windows_of(v)) >= 0.8}
    assert alike <= met and len(alike) == 120
    assert len(met - alike) < 0.05 * (len(texts) * len(items) - len(alike))


def test_sql_finds_windows_that_are_not_lined_up(spark, tmp_path):
    """The SQL tries all windows; it gives what the operator gives on trimmed items with insertions."""
    import duckdb
    from ballotlens.llm.queries import ORACLE_SQL
    rng = random.Random(31)
    items = [(k, prose(rng, 59)) for k in range(6)]
    rows = []
    for k in range(40):
        w = items[k % 6][1].split()
        w = w[rng.randint(0, 2):59 - rng.randint(0, 2)]
        w[25:25] = prose(rng, rng.randint(0, 4)).split()
        rows.append((k, f"{prose(rng, rng.randint(0, 30))} {' '.join(w)} {prose(rng, rng.randint(0, 30))}"))
    rows.append((100, " ".join(prose(rng, 9).split() + items[0][1].split()[1:30] + prose(rng, 2).split()
                               + items[0][1].split()[30:58] + prose(rng, 9).split())))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in contaminated(frame(spark, rows), bench).collect()}
    with duckdb.connect() as con:
        for table, df in (("documents", frame(spark, rows)), ("benchmark", bench)):
            df.write.parquet(f"{tmp_path}/{table}")
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}/*.parquet'")
        want = {(d, i): (s, a) for d, i, s, a in con.execute(ORACLE_SQL["op6_decontamination"]).fetchall()}
    assert got == want and (100, 0) in want and {k: s for k, (s, _) in want.items()} == pytest.approx(best_windows(rows, items))


# ---------------------------------------------------------------- personal data
PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if k == 0 or (k == 1 and all(int(p) <= 255 for p in m.group().split("."))) \
                    or (k == 2 and 12 <= len(d) <= 19 and pii.luhn(d)) or (k == 3 and 9 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_regexes():
    rng = random.Random(0)
    for _ in range(20000):
        t = "".join(rng.choice("a@.1234+ -()9é@..4") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("1" * 200_000 + "." + "@" * 1000 + "a" * 200_000) == []


def test_personal_data_of_documents(spark):
    rng = random.Random(6)
    base = ["jo.x{}@mail.example.org", "10.2.33.{}", "+1 (212) 555-01{}", "4111 1111 1111 1111"]
    rows = []
    for i in range(300):
        w = prose(rng, rng.randint(1, 40)).split()
        w.insert(rng.randrange(len(w)), rng.choice(base).format(rng.randint(10, 99)))
        if i % 3 == 0:
            w.insert(rng.randrange(len(w)), str(rng.randrange(10 ** rng.randint(5, 14))))
        rows.append((i, " ".join(w)))
    rows += [(900, None), (901, ""), (None, "ring +44 20 7946 0958"), (3, rows[3][1]), (902, prose(rng, 20000) + " a@b.c")]
    found = pii.find_personal_data(frame(spark, rows)).cache()
    got = found.collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t or "")
    for r in got:
        want = plain_spans(texts[r.doc_id])
        assert [tuple(s) for s in r.base] == want
        spans = [tuple(s) for s in r.spans]
        assert set(want) <= set(spans) and spans == sorted(spans)
    import hashlib
    for r in pii.digest_table(found).collect():
        want = plain_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in got}
    clean = {r.doc_id: r for r in pii.without_personal_data(frame(spark, rows)).collect()}
    assert clean[900].text is None and clean[901].text == "" and clean[None].text == "ring [PHONE]"
    assert all((r.text or "") == pii.redact(texts[i], spans[i]) for i, r in clean.items())
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in clean.values())
    assert pii.find_personal_data(frame(spark, [])).count() == 0
    assert pii.without_personal_data(frame(spark, [])).count() == 0


def test_candidates_need_no_digit_elsewhere():
    texts = [f"write to jane {at} example.com{more}" for at in ("(at)", "[at]", "at") for more in ("", " 7")] + ["ab:cd:ef:ab:cd:ef:ab:cd"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    found = [r for b in pii._propose(iter([batch])) for r in b.to_pylist()]
    assert all([texts[r["doc_id"]][c["start"]:c["end"]] for c in r["proposed"]] for r in found)
    for a, b in zip(found[0:6:2], found[1:6:2]):
        assert [(c["start"], c["end"]) for c in a["proposed"]] == [(c["start"], c["end"]) for c in b["proposed"]]


def test_common_obfuscated_data_is_added(spark):
    rng = random.Random(41)
    base = ["jo.x{}@mail.example.org", "10.2.33.{}", "+1 (212) 555-01{}", "4111 1111 1111 1111"]
    other = ["ann{} (at) example (dot) org", "kim{} at example dot com", "212 555 01{}"]
    wrong = ["2021-03-{}", "they arrive at noon. The {}", "4111 1111 1111 11{}"]
    rows, planted, false = [], {}, {}
    for i in range(600):
        kinds, sort = ((base, None), (other, planted), (wrong, false))[0 if i < 300 else 1 + i % 2]
        x = kinds[i // 2 % len(kinds)].format(rng.randint(12, 28))
        if sort is false and x.startswith("4111"):
            x = "4111 1111 1111 1112"
        before = prose(rng, rng.randint(1, 30)) + " "
        rows.append((i, f"{before}{x}. {prose(rng, 20).capitalize()}"))
        if sort is not None:
            sort[i] = (len(before), len(before) + len(x))
    got = {r.doc_id: {(s.start, s.end) for s in r.spans} for r in pii.find_personal_data(frame(spark, rows)).collect()}
    assert all(span in got[i] for i, span in planted.items())
    assert not any(got[i] for i in false)


def test_one_calibration_rule_at_every_size():
    rng = np.random.default_rng(4)
    scores, labels = np.concatenate([rng.uniform(0.7, 1, 80), rng.uniform(0, 0.6, 80)]), np.repeat([1.0, 0.0], 80)
    limit = pii.calibrate(scores, labels, 0.99)
    assert 0.6 < limit <= scores[labels == 1].min()
    for copies in (2, 10, 100):                     # more rows of the same kind: the same threshold
        assert pii.calibrate(np.tile(scores, copies), np.tile(labels, copies), 0.99) == limit
    x = np.stack([scores, rng.uniform(0, 1, 160)], axis=1)
    order = rng.permutation(160)
    model, threshold = pii.learn(x[order], labels[order], np.ones(160, bool))
    assert model is not None and 0.5 <= threshold < 1


def test_time_grows_with_the_text_alone():
    import time
    took = []
    for n in (20_000, 80_000):
        text = "1." * n
        base, start = pii.base_spans(text), time.process_time()
        found = pii.candidates(text, base)
        pii._choose([{"start": a, "end": b} for a, _, b in base], found, np.ones(len(found)), 0.5)
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 1


def test_long_names_and_hosts_are_proposed_whole():
    text = f"mail {'n' * 500}@{'.'.join(['part' * 30] * 12)}.org now"
    spans = {(c["start"], c["end"]) for c in pii.candidates(text, pii.base_spans(text)) if c["start"] >= 0}
    assert (5, len(text) - 4) in spans


def test_vocabulary_counted_by_chunks():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["ba", "deki", "lomuna", "pe", prose(rng, 1)]) for _ in range(rng.randint(0, 12))) for _ in range(90)]
    parts = toxicity._tokens(pa.array(texts))
    whole = toxicity._vocabulary(*parts, chunk=1000)
    assert len(whole) and all((toxicity._vocabulary(*parts, chunk=n) == whole).all() for n in (1, 7, 64))


def test_boosted_trees_and_thresholds():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    scores = boosting.predict(model, x[1500:])
    assert ((scores >= 0.5) == y[1500:]).mean() > 0.95
    limit = pii.calibrate(scores, y[1500:], 0.99)
    assert y[1500:][scores >= limit].mean() >= 0.99
    assert pii.calibrate(scores[:10], y[1500:1510], 0.99) == float("inf")


# ---------------------------------------------------------------- licences
def test_every_template_is_found_and_nothing_else(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for i, (name, notice) in enumerate(L.TEMPLATES):
        assert L._has_anchor(notice)
        rows.append((i, f"{prose(rng, 60)}\n{notice}\n{prose(rng, 60)}"))
        start = rows[-1][1].index(notice)
        want[i] = (name, start, start + len(notice.rstrip(".:")), 0)
    rows += [(100, None), (101, ""), (102, "a license to be clean"), (103, prose(rng, 50)), (104, "Copyright, permission, permitted."),
             (105, "Licensed under the Apache License, Version 3.0."), (106, "RELEASED  under the mit\nlicence!"),
             (107, "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0. Released under the MIT License."),
             (108, prose(rng, 20000) + " Released under the MIT License. " + prose(rng, 2000)), (None, "Released under the MIT License."),
             (0, rows[0][1])]
    got = {}
    for r in L.license_notices(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.license_id, r.start, r.end, r.n_differences))
    for i, w in want.items():
        assert sorted(set(got[i])) == [w]
    assert len(got[0]) == 2 and not {100, 101, 102, 103, 104, 105} & got.keys()
    assert [g[0] for g in got[106]] == ["MIT"] and [g[0] for g in got[108]] == ["MIT"] and [g[0] for g in got[None]] == ["MIT"]
    assert sorted(g[0] for g in got[107]) == ["CC-BY-4.0", "CC-BY-NC-4.0", "MIT"]
    assert L.license_notices(frame(spark, [])).count() == 0


def test_versions_within_one_block_and_broken_lines():
    first = "This work is licensed under the GNU General Public License, version 2."
    second = "This software is licensed under the GNU General Public License, version 3."
    found = L.find_notices(f"{first} {'Some words between. ' * 3}{second}", L.Compressor())
    assert [r["license_id"] for r in found] == ["GPL-2.0", "GPL-3.0"]
    notice = "This is free and unencumbered software released into the public\n   domain."
    assert L._has_anchor(notice) and [r["license_id"] for r in L.find_notices(notice, L.Compressor())] == ["Unlicense"]


def test_identifiers_titles_versions_and_sentences():
    compressor = L.Compressor()
    for i, (name, notice) in enumerate(L.VERSIONS, len(L.TEMPLATES)):
        found = L.find_notices(f"ba de lomu.\n{notice}\nfe", compressor)
        assert [(r["license_id"], r["template"], r["start"], r["n_differences"]) for r in found] == [(name, i, 12, 0)]
    for text, name in (("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-2.0", "GPL-2.0-only"),
                       ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", "GPL-2.0"), ("Licensed under CC-BY-SA 3.0", "CC-BY-SA-3.0"),
                       ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", "MIT"),
                       ("This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                        "General Public License as published by the Free Software Foundation, either version 2.1 of the License, or "
                        "(at your option) any later version.", "LGPL-2.1-or-later")):
        assert [r["license_id"] for r in L.find_notices(f"ba de\n{text}\nlo mu", compressor)] == [name]
    for text in ("Licensed under CC BY 9.0.", "It comes without warranty of any kind.", "SPDX-License-Identifier: Other-9"):
        assert L.find_notices(text, compressor) == []
    twice = "Licensed under CC BY-SA 3.0. Licensed under CC BY-SA 3.0."
    assert [(r["start"], r["license_id"]) for r in L.find_notices(twice, compressor)] == [(0, "CC-BY-SA-3.0"), (29, "CC-BY-SA-3.0")]


def plain_notices(text, compressor):
    """Every template against every stretch of words, best first, no word twice."""
    spoken, taken, out = [L._plain(w) for w in re.findall(r"[^\W_]+", text)], set(), []
    saved = compressor.saved(text, list(range(len(L.ALL))))
    while True:
        best = None
        for i, (name, notice) in enumerate(L.ALL):
            t = [L._plain(w) for w in re.findall(r"[^\W_]+", notice)]
            must = {w for w, k in zip(t, L.key_words(notice)) if k}
            if saved[i] < 0.2 or not must <= set(spoken):
                continue
            for a in range(len(spoken)):
                for b in range(a + 1, min(len(spoken), a + len(t) + len(t) // 5) + 1):
                    if b - a >= len(t) - len(t) // 5 and must <= set(spoken[a:b]) and not taken & set(range(a, b)):
                        d = distance(t, spoken[a:b])
                        rank = (d / len(t), -saved[i], -len(t), i)
                        if d <= 0.2 * len(t) and (best is None or rank < best[0]):
                            best = (rank, a, b, name, d)
        if best is None:
            return [(name, d) for _, name, d in sorted(out)]
        taken |= set(range(best[1], best[2]))
        out.append((best[1], best[3], best[4]))


def test_ranking_and_selection_equal_brute_force():
    rng, compressor = random.Random(41), L.Compressor()
    short = [i for i, words in enumerate(L.WORDS) if len(words) <= 16]
    for _ in range(40):
        parts = [prose(rng, rng.randint(0, 6))]
        for i in rng.choices(short, k=rng.randint(1, 2)):
            notice, keys = L.ALL[i][1].split(" "), L.KEYS[i]
            plain = len(notice) == len(keys) and [k for k, key in enumerate(keys) if not key]
            if plain and rng.random() < 0.5:
                notice[rng.choice(plain)] = prose(rng, 1)
            parts += [" ".join(notice), prose(rng, rng.randint(2, 8))]
        text = " ".join(parts)
        got = [(r["license_id"], r["n_differences"]) for r in L.find_notices(text, compressor)]
        assert got == plain_notices(text, compressor), text


def test_wording_differences_equal_edit_distance():
    rng = random.Random(2)
    for _ in range(200):
        t, b = ([rng.choice("abcd") for _ in range(rng.randint(1, 5))] for _ in range(2))
        best = min(distance(t, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        found = L.align(t, [False] * len(t), b, [False] * len(b))
        assert (found[0] if found else best) == best


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        d, last = [i], d
        for j, y in enumerate(b, 1):
            d.append(min(last[j] + 1, d[j - 1] + 1, last[j - 1] + (x != y)))
    return d[-1]

"""Each operator against its plain version, on fixtures with nulls, empties, ties, repeats and clashing columns."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from changeflow.llm import chat, licenses, lm_scores, simhash, suffix_dedup
from changeflow.llm.components import connected_components
from changeflow.llm.decontaminate import benchmark_matches, contamination, tokenized
from changeflow.llm.line_dedup import dedup_lines
from changeflow.llm.mixing import source_targets, weighted_fair_mix
from changeflow.llm.quality import quality_report
from changeflow.llm.url_filter import Rule, filter_urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, words string, id string, t string"


def vocabulary(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice("abcdeéü") for _ in range(r.randint(2, 7))) for _ in range(n)]


def prose(r, words, n):
    return " ".join(r.choice(words) for _ in range(n))


def corpus(seed=3):
    """Texts with copies, shared passages, repeated lines, nulls and blanks."""
    r, words = random.Random(seed), vocabulary(400, seed)
    passage = prose(r, words, 90)
    texts = [None, "", "   \n \t", "one", "a b"]
    for _ in range(14):
        lines = [prose(r, words, r.randint(3, 40)).capitalize() + "." for _ in range(r.randint(1, 12))]
        if r.random() < 0.5:
            lines.insert(r.randint(0, len(lines)), passage)
        if r.random() < 0.3:
            lines += lines[:2]
        texts.append("\n".join(lines))
    texts += [texts[8], texts[8] + " tail", texts[9].replace(".", "!", 1), "x" * 900, "ab" * 700]
    return texts


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"s{(i or 0) % 4}" if (i or 0) % 5 else None, len(t or ""), "clash", "clash", "clash", "clash")
            for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- 1
def test_suffix_dedup_equals_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r for r in suffix_dedup.cut_repeats(frame(spark, texts)).collect()}
    for i, want in enumerate(brute.suffix_dedup(texts, 400)):
        r = got[i]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) == want, i


def test_suffix_dedup_repeated_rows_remove_each_other_and_seams_hold(spark, monkeypatch):
    r = random.Random(5)
    text = "".join(chr(r.randint(97, 122)) for _ in range(1500))
    rows = suffix_dedup.cut_repeats(frame(spark, [text, text, "short"], ids=[1, 1, None])).collect()
    assert sorted(len(x.kept) for x in rows) == [0, 0, 5]
    whole = suffix_dedup.anchors(text.encode())
    monkeypatch.setattr(suffix_dedup, "_PIECE", 100)
    assert suffix_dedup.anchors(text.encode()) == whole
    assert suffix_dedup.cut_repeats(empty(spark)).count() == 0


# ---------------------------------------------------------------- 2
def test_license_rules(spark):
    mit = "\n".join(licenses.SENTENCES[f"mit.{k}"] for k in ("grant", "notice", "warranty", "liability"))
    wrapped = mit.replace(" software", "\nsoftware").replace(" THE", "\nTHE")
    apache = " ".join(licenses.SENTENCES[f"apache.{k}"] for k in ("header", "comply", "copy")) + (
        "\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n") + " ".join(
        licenses.SENTENCES[f"apache.{k}"] for k in ("unless", "see"))
    bsd = " ".join(licenses.SENTENCES[f"bsd.{k}"] for k in ("redistribution", "source", "binary", "endorse"))
    texts = [None, "", mit, wrapped, "Prose first.\nReleased under the MIT License.\nMore prose.", apache, bsd,
             "permission to copy this is granted", licenses.SENTENCES["mit.grant"],
             "Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3.",
             "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."]
    got = {r.doc_id: (r.n_rules, r.rules, r.licenses) for r in licenses.license_scan(frame(spark, texts)).collect()}
    none = (0, "", "")
    assert [got[i] for i in range(len(texts))] == [
        none, none, (1, "mit-text", "MIT"), (1, "mit-text", "MIT"), (1, "mit-notice", "MIT"),
        (1, "apache-2-header", "Apache-2.0"), (1, "bsd-3-text", "BSD-3-Clause"), none, none,
        (2, "cc-by-nc-notice,gpl-3-notice", "CC-BY-NC-4.0,GPL-3.0-only"), (1, "cc-by-nc-notice", "CC-BY-NC-4.0")]
    assert licenses.license_scan(empty(spark)).count() == 0


def test_license_order_and_gap_matter(spark):
    s = licenses.SENTENCES
    swapped = " ".join(s[f"bsd.{k}"] for k in ("source", "redistribution", "binary"))
    far = s["bsd.redistribution"] + " x. y. z. " + s["bsd.source"] + " " + s["bsd.binary"]
    near = s["bsd.redistribution"] + " x. y. " + s["bsd.source"] + " " + s["bsd.binary"]
    got = {r.doc_id: r.rules for r in licenses.license_scan(frame(spark, [swapped, far, near])).collect()}
    assert got == {0: "", 1: "", 2: "bsd-2-text"}


@pytest.mark.parametrize("first,leader,last", [("/*", " * ", " */"), ("", "# ", ""), ("", "// ", ""), ("", "-- ", ""),
                                               ("", ";; ", ""), ("", "; ", ""), ("", "! ", ""), ("<!--", "  ", "-->")])
def test_licenses_in_comments(spark, first, leader, last):
    """Each licence text of several sentences, wrapped, below a copyright line without a full stop."""
    import textwrap
    texts, want = [], []
    for rule, licence, names in licenses.RULES:
        parts = [licenses.SENTENCES[n] for n in names]
        if rule == "apache-2-header":
            parts = [" ".join(parts[:3]), "    http://www.apache.org/licenses/LICENSE-2.0", " ".join(parts[3:])]
        if len(names) > 1 or rule in ("isc-text", "mpl-2-header"):
            lines = ["Copyright (c) 2020 Someone", ""]
            for p in parts:
                lines += [*textwrap.wrap(p, 60), ""]
            texts.append("\n".join([first, *((leader + x).rstrip() for x in lines), last, "int main() {}"]))
            want.append((rule, licence))
    got = {r.doc_id: (r.rules, r.licenses) for r in licenses.license_scan(frame(spark, texts)).collect()}
    assert len(want) >= 8 and [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("text,want", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-only"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
    ("Released under CC0 1.0.", "CC0-1.0"), ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause"),
    ("Released under the BSD License", "BSD"), ("Distributed under GPLv2+.", "GPL-2.0-or-later"),
    ("Distributed under GPLv2.", "GPL-2.0-only"), ("This project is licensed under the MIT License", "MIT"),
    ("Licensed under the terms of the GNU Lesser General Public License v2.1 or later.", "LGPL-2.1-or-later"),
    ("This program is released under the GNU Affero General Public License v3.0", "AGPL-3.0-only"),
    ("Licensed under the Eclipse Public License 2.0", "EPL-2.0"), ("MIT License\n\nx", "MIT"),
    ("Copyright X\nAll rights reserved.", "All-Rights-Reserved"), ("// SPDX-License-Identifier: LGPL-3.0-or-later", "LGPL-3.0-or-later"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
     "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
     "LGPL-2.1-or-later"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License.", "CC-BY-NC-ND-3.0")])
def test_license_families(spark, text, want):
    assert licenses.license_scan(frame(spark, ["Some prose.\n" + text])).first().licenses == want


def test_license_rules_are_subsequences_and_names_differ(spark):
    s = licenses.SENTENCES
    bsd = [s[f"bsd.{k}"] for k in ("redistribution", "source", "binary")]
    owners = ["Neither the name of the <organization> nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.",
              s["bsd.endorse"].replace("the copyright holder", "Example Widgets GmbH"),
              s["bsd.endorse"].replace("the copyright holder", "Example Inc."),
              "The name of the author may not be used to endorse or promote products derived from this software without "
              "specific prior written permission."]
    texts = [" ".join([*bsd, o]) for o in owners]
    # A known sentence between two of a rule is one like any other.
    texts.append(" ".join([bsd[0], "All rights reserved.", *bsd[1:]]))
    # The first of two sources is too far from the binary clause, the second is not.
    texts.append(" ".join([bsd[0], bsd[1], "x.", bsd[1], "x. y.", bsd[2]]))
    got = {r.doc_id: r.licenses for r in licenses.license_scan(frame(spark, texts)).collect()}
    assert got == {0: "BSD-3-Clause", 1: "BSD-3-Clause", 2: "BSD-3-Clause", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "BSD-2-Clause"}


def test_license_sql_is_the_operators_definition(spark):
    """Commented headers, grant, owner and version wordings, sentences between a rule's own, rules inside rules."""
    import duckdb
    import pandas as pd

    from changeflow.llm import oracles
    s = licenses.SENTENCES
    apache = [s[f"apache.{k}"] for k in ("header", "comply", "copy", "unless", "see")]
    bsd = [s["bsd.redistribution"], s["bsd.source"], s["bsd.binary"], s["bsd.endorse"]]
    texts = ["\n".join(f"// {x}" for x in apache), "/*\n * " + "\n * ".join(apache) + "\n */\nint main() {}",
             "This program is licensed under the GNU General Public License, version 2.", "All rights reserved.",
             "Released under the terms of the MIT license.", "Distributed under GPLv2+.", " ".join(bsd), " ".join(bsd[:3]),
             " ".join([*bsd[:3], bsd[3].replace("the copyright holder", "Example & Sons, Inc.")]),
             " ".join([bsd[0], "All rights reserved.", *bsd[1:]]), " ".join([bsd[0], bsd[1], "x.", bsd[1], "x. y.", bsd[2]]),
             " ".join([bsd[0], "a. b. c. d. e. f. g.", *bsd[1:]]), " ".join([*bsd, *bsd[:3], s["mit.short"], *apache]), None, "", "plain text",
             "# " + s["spdx.gpl3"], *[w for ws in licenses.license_families.families()[0].values() for w in ws]]
    got = {r.doc_id: (r.n_rules, r.rules, r.licenses) for r in licenses.license_scan(frame(spark, texts)).collect()}
    con = duckdb.connect()
    con.register("texts", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    want = {d: (n, r, lic) for d, n, r, lic in con.sql(oracles.license_scan("texts")).fetchall()}
    assert got == want and sum(n > 0 for n, _, _ in want.values()) > 20


# ---------------------------------------------------------------- 3
@pytest.mark.parametrize("text", ["", " ", "\\", "a\\ ", chat.EXAMPLE, "\\</s>", "\\\\[INST]", "<s> </s>", " [/INST]",
                                  "<<SYS>> x <</SYS>>", "[ROLE a] b [/ROLE]", "é\n\t[/ROLE]", "<<s>", "</s></s>\\"])
@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool ]x\n", ""])
def test_chat_round_trip(role, text):
    piece, a, b = chat.render(role, text)
    assert chat.read_back(piece + piece) == [(role, text)] * 2
    assert chat.unescape(piece[a:b]) == text


def test_chat_folds_events(spark):
    log = [(1, "m2", 5, "delta", "assistant", "lo"), (1, "m1", 1, "message", "user", "hi"),
           (1, "m2", 3, "message", "assistant", ""), (1, "m2", 4, "delta", None, "hel"),
           (1, "m1", 9, "edit", "user", "hello?"), (1, "m3", 6, "message", "assistant", "bad"),
           (1, "m3", 7, "regenerate", None, None), (1, "m3", 8, "delta", None, "good"),
           (2, "a", None, "message", None, None), (None, "a", 1, "message", "user", "x"),
           (3, "t", 1, "message", "user", "same"), (3, "t", 1, "message", "user", "same")]
    events = spark.createDataFrame(log, "conv_id long, message_id string, seq long, kind string, role string, text string")
    got = sorted((r.conv_id or 0, r.seq or 0, r.role, r.text) for r in chat.final_messages(events).collect())
    assert got == [(0, 1, "user", "x"), (1, 1, "user", "hello?"), (1, 3, "assistant", "hello"),
                   (1, 6, "assistant", "good"), (2, 0, "", ""), (3, 1, "user", "same"), (3, 1, "user", "same")]


def test_chat_ids_keep_their_type(spark):
    turns = spark.createDataFrame([("a-1", 0, "user", "hi"), (None, 0, "user", "x")], "conv_id string, turn long, role string, text string")
    out = chat.digest(chat.format_messages(chat.final_messages(chat.turn_events(turns)))).collect()
    assert sorted((r.conv_id or "", r.n_turns) for r in out) == [("", 1), ("a-1", 1)]


def test_chat_digests(spark):
    turns = spark.createDataFrame(
        [(7, 1, "assistant", "ok </s>"), (7, 0, "user", None), (7, 2, "assistant", "é"), (8, 0, "bot", "x")],
        "conv_id long, turn long, role string, text string").unionByName(chat.example_turns(spark))
    rows = chat.digest(chat.format_messages(chat.final_messages(chat.turn_events(turns)))).collect()
    got = {r.conv_id: r for r in rows}
    assert got[7].n_turns == 3 and got[7].loss_chars == 8
    assert got[7].turns_sha256 == brute.sha("user\n\nassistant\nok </s>\nassistant\né\n")
    assert got[7].loss_sha256 == brute.sha("ok </s>é")
    assert got[8].turns_sha256 == brute.sha("bot\nx\n") and got[8].loss_chars == 0
    assert got[-1].turns_sha256 == brute.sha(f"user\n{chat.EXAMPLE}\nassistant\n{chat.EXAMPLE}\n")
    assert got[-1].loss_sha256 == brute.sha(chat.EXAMPLE)
    assert chat.digest(chat.format_messages(chat.final_messages(chat.turn_events(turns.limit(0))))).count() == 0


# ---------------------------------------------------------------- 4
def test_quality_equals_brute_force(spark):
    texts = corpus() + ["a b c d e " * 5, "a b c d e f g h i j", "a b c d a b c d a b c d e f g"]
    got = {r.doc_id: r for r in quality_report(frame(spark, texts), keep=("t", "words")).collect()}
    for i, t in enumerate(texts):
        r, want = got[i], brute.quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]), i
        assert not (r.base_failed and r.kept) and r.t == "clash"
    assert quality_report(empty(spark)).count() == 0


def test_quality_line_rules(spark):
    good = "The quick brown fox jumps over the lazy dog near the river bank today."
    menu = "Home | News | Sport | Weather | Video | Audio | More | Shop | About | Help"
    other = "A slow green turtle walks under one tall old oak tree behind our house."
    texts = [good, f"{good}\n{other}\nHome", menu, f"{good}\n{menu}\n{menu[::-1]}",
             " ".join(["word###"] * 5 + ["x$$$"] * 7 + ["%%%%"] * 4), "Ten words without any closing mark but still plain prose text"]
    got = {r.doc_id: r.kept for r in quality_report(frame(spark, texts)).collect()}
    assert got == {0: True, 1: True, 2: False, 3: False, 4: False, 5: True}


def test_quality_gives_the_text_without_failing_lines(spark):
    good = "The quick brown fox jumps over the lazy dog near the river bank today."
    other = "A slow green turtle walks under one tall old oak tree behind our house."
    texts = [good, f"Home\n{good}\n\n{other}\nHome\n", None, "", "Home", corpus()[9]]
    rows = quality_report(frame(spark, texts), keep=("t",), cleaned=True).collect()
    got = {r.doc_id: (r.clean_text, list(r.removed_lines)) for r in rows}
    assert [got[i] for i in range(5)] == [(good, []), (f"{good}\n\n{other}\n", [0, 4]), (None, []), ("", []), ("", [0])]
    for r in rows:
        lost = sum(len(x) for i, x in enumerate((texts[r.doc_id] or "").split("\n")) if i in r.removed_lines)
        assert lost == r.line_chars - r.good_line_chars and r.t == "clash"


# ---------------------------------------------------------------- 5
def test_lm_base_score_equals_brute_force_and_model_is_normalised(spark):
    import math
    import zlib
    from collections import Counter

    import numpy as np
    texts = corpus() * 2
    rows = {r.doc_id: r for r in lm_scores.lm_scores(frame(spark, texts), lookup=50, vocabulary=20, shapes=4).collect()}
    tokens = [brute.WORD.findall(brute.lower(t or "")) + ["\n"] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(tokens):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(w in c for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    model = lm_scores.Model(30, 8, np.arange(1.0, 31))
    ctx = np.array([0, 5, 30]), np.array([30, 2, 30])
    for k in range(3):
        p = np.exp(model.log_prob(np.full(30, ctx[0][k]), np.full(30, ctx[1][k]), np.arange(30)))
        assert abs(p.sum() - 1) < 1e-4


def test_lm_scores_do_not_depend_on_the_lookup_size(spark):
    """Which words are looked up by a join is a matter of cost: base figures agree, and unknown words too."""
    docs = frame(spark, corpus(4) * 2)
    few, many = ({r.doc_id: r for r in lm_scores.lm_scores(docs, lookup=n, vocabulary=1, shapes=4).collect()} for n in (2, 10 ** 5))
    for i, r in few.items():
        assert (r.n_known, r.n_tokens) == (many[i].n_known, many[i].n_tokens)
        assert abs(r.base_score - many[i].base_score) < 1e-9 * max(1, -r.base_score)
        assert abs(r.score - many[i].score) < 1e-3 * max(1, -r.score)


def test_lm_learns_and_defined_cases(spark):
    r = random.Random(1)
    # Two languages: the context tells which words follow.
    a, b = vocabulary(40, 1), [w.upper() + "ö" for w in vocabulary(40, 2)]
    texts = [prose(r, a if k % 2 else b, 150) for k in range(300)]
    out = lm_scores.lm_scores(frame(spark, texts)).where("held_out")
    better = out.agg(F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()[0]
    assert better > 0.9
    assert lm_scores.lm_scores(empty(spark)).count() == 0
    only = lm_scores.lm_scores(frame(spark, ["x y"], ids=[5]), held_out=F.lit(True)).first()
    assert (only.n_known, only.train_tokens, only.n_tokens, only.base_score) == (0, 0, 3, 0.0)


# ---------------------------------------------------------------- 6
def test_simhash_fingerprint_and_groups_equal_brute_force(spark):
    texts = corpus() + ["a b c", "A  b\tc", "Ä b", "ä b"]
    ids = [*range(len(texts) - 1), 0]
    rows = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(frame(spark, texts, ids)).collect()]
    fps, groups = brute.simhash_groups(list(zip(ids, texts)))
    assert sorted(rows) == sorted((i, f"{f:016x}", g) for i, f, g in zip(ids, fps, groups))
    assert simhash.simhash_groups(empty(spark)).count() == 0
    nulls = simhash.simhash_groups(frame(spark, ["a b c d", "a b c d"], [None, 4])).collect()
    assert {r.component_id for r in nulls} == {4}


@pytest.mark.parametrize("hot,split", [(10 ** 6, 10), (200, 6), (60, 3)])
def test_trie_join_links_all_near_pairs(spark, hot, split):
    r, fps = random.Random(2), set()
    for _ in range(40):
        base = r.getrandbits(64)
        for _ in range(10):
            x = base
            for _ in range(r.randint(0, 5)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    top = r.getrandbits(16) << 48
    fps |= {top | r.getrandbits(18) for _ in range(700)} | {r.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    up = {x: x for x in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                up[find(x)] = find(y)
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(sign(x),) for x in fps], "fp long")
    label = {r.node: r.component for r in connected_components(simhash.near_links(df, 3, hot, split)).collect()}
    got, want = {}, {}
    for x in fps:
        got.setdefault(label.get(sign(x), sign(x)), set()).add(x)
        want.setdefault(find(x), set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_on_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000), (None, 3), (1, 0)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}


# ---------------------------------------------------------------- 7
def test_targets_share_caps_and_reshare(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 500), ("d", 0), (None, 700)]
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    left, open_, want = 2210.0, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, {}
    size = dict(sizes)
    while True:                                  # hand out by weight, cap, share the excess again
        total = sum(open_.values())
        over = [s for s in open_ if left * open_[s] / total > 3 * size[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * size[s]
            del open_[s]
        left = 2210.0 - sum(want.values())
    want |= {s: left * w / total for s, w in open_.items()}
    assert got == pytest.approx(want)


def test_mix_takes_targets_and_reruns_agree(spark):
    r, words = random.Random(4), vocabulary(50)
    texts = [prose(r, words, r.randint(1, 30)) for _ in range(800)] + [None, ""]
    docs = frame(spark, texts)
    rows = weighted_fair_mix(docs, slice_digits=1, carry=("t",)).collect()
    by = {}
    for x in rows:
        assert x.taken == x.copies * x.size and 0 <= x.copies <= 3 and x.t == "clash"
        by.setdefault((x.source, x.source_size, x.target), []).append(x.taken)
    total = sum(s for _, s, _ in by)
    assert sum(sum(v) for v in by.values()) <= total
    for (_, _, target), taken in by.items():
        assert abs(sum(taken) - target) <= 31
    again = weighted_fair_mix(docs.repartition(5), slice_digits=2).collect()
    assert sorted((x.doc_id, x.copies) for x in again) == sorted((x.doc_id, x.copies) for x in rows)
    assert weighted_fair_mix(empty(spark)).count() == 0
    twins = weighted_fair_mix(frame(spark, ["a b", "a b", None], [1, 1, None])).collect()
    assert sorted(x.taken for x in twins) in ([0, 2, 2], [0, 0, 4])


# ---------------------------------------------------------------- 8
def test_decontamination_equals_brute_force(spark):
    r, words = random.Random(6), vocabulary(60, 6)
    bench = [(i, prose(r, words, r.randint(12, 30))) for i in range(6)] + [
        (6, "two words"), (7, None), (8, "..."), (9, "Only"), (9, prose(r, words, 11)), (10, "é É e")]
    texts = [None, "", "two, Words!", "only", "e é É e", prose(r, words, 40)]
    for i in range(6):
        item = bench[i][1].split()
        texts.append(prose(r, words, 20) + " " + " ".join(item[1:11]).upper() + ", " + prose(r, words, 9))
        texts.append(prose(r, words, 5) + " " + " ".join(item[:9]))
        texts.append(" - ".join(item * 2))
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {x.doc_id: x for x in contamination(frame(spark, texts), items, keep=("words",)).collect()}
    for i, t in enumerate(texts):
        n, hit, ids = brute.decontaminate(t, bench)
        x = got[i]
        assert (x.n_words, x.n_hit, x.n_items, x.contaminated) == (n, hit, len(ids), hit > 0), (i, t)
        assert x.items_sha256 == brute.sha(",".join(ids)) and x.words == "clash"
    assert contamination(empty(spark), items).count() == 0
    assert not contamination(frame(spark, texts), items.limit(0)).where("contaminated").count()


def test_decontamination_with_full_bit_fields(spark, monkeypatch):
    """However full the fields are, nothing is lost and the join drops what they let through."""
    from changeflow.llm import decontaminate
    r, words = random.Random(11), vocabulary(80, 11)
    bench = [(i, prose(r, words, 25)) for i in range(30)]
    texts = [prose(r, words, 30) + " " + bench[i][1] + " " + prose(r, words, 30) for i in range(0, 30, 3)] + [prose(r, words, 200)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "FILTER_BITS", (64, 64))
    got = {x.doc_id: (x.n_words, x.n_hit, x.n_items) for x in contamination(frame(spark, texts), items).collect()}
    for i, t in enumerate(texts):
        n, hit, ids = brute.decontaminate(t, bench)
        assert got[i] == (n, hit, len(ids))


def test_proximity_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    shuffled = "alpha gamma beta delta zeta epsilon eta theta kappa iota lambda"
    docs = frame(spark, [item, shuffled, "nothing of it"])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kinds = {(x.doc.id, x.kind) for x in benchmark_matches(tokenized(docs), bench).collect()}
    assert kinds == {(0, "phrase"), (1, "near")}


def test_proximity_matches_need_no_neighbour_and_no_whole_window(spark):
    """A word inserted on both sides of the pivot, and a short item with a word that no document has."""
    common = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    item = common.replace("epsilon", "pivotal")
    docs = frame(spark, [common, common, item.replace("pivotal", "x pivotal y"), "one two red four five six seven", "nothing of it",
                         "one two three"])
    bench = spark.createDataFrame([(1, item), (2, "one two missing four five six seven")], "item_id long, text string")
    kinds = {(x.doc.id, x.item_id, x.kind) for x in benchmark_matches(tokenized(docs), bench).collect()}
    assert {(0, 1, "near"), (1, 1, "near"), (2, 1, "near"), (3, 2, "near")} == kinds
    got = {x.doc_id: x for x in contamination(docs, bench, proximity=True).collect()}
    assert {i: (x.n_near, x.near_sha256) for i, x in got.items()} == {
        i: (int(i < 4), brute.sha({0: "1", 1: "1", 2: "1", 3: "2"}.get(i, ""))) for i in range(6)}
    assert not any(x.contaminated or x.n_items for x in got.values())


@pytest.mark.parametrize("bits", [(64, 64), (1 << 16, 1 << 20)])
def test_proximity_matches_lose_none(spark, monkeypatch, bits):
    """Passages with words changed, moved, dropped and put in, against every span of every document."""
    from changeflow.llm import decontaminate
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
    r, words = random.Random(21), vocabulary(300, 21)
    bench = [(i, prose(r, words, r.choice([3, 5, 7, 10, 25]))) for i in range(40)] + [(7, prose(r, words[:4], 12)), (None, prose(r, words, 12))]
    texts = [None, "", prose(r, words, 400)]
    for _, item in bench:
        for changes in range(4):
            w = item.split()
            for _ in range(changes):
                at = r.randrange(len(w))
                kind = r.choice(["change", "drop", "put", "swap"])
                if kind == "change":
                    w[at] = r.choice(words)
                elif kind == "drop" and len(w) > 1:
                    w.pop(at)
                elif kind == "put":
                    w.insert(at, r.choice(words))
                else:
                    b = min(len(w) - 1, at + 2)
                    w[at], w[b] = w[b], w[at]
            texts.append(f"{prose(r, words, r.randint(0, 30))} {' '.join(w)} {prose(r, words, r.randint(0, 30))}")
    rows = frame(spark, texts)
    got = {x.doc_id: x for x in contamination(rows, spark.createDataFrame(bench, "item_id long, text string"), proximity=True).collect()}
    found = 0
    for i, t in enumerate(texts):
        near = brute.near_items(t, bench)
        assert (got[i].n_near, got[i].near_sha256) == (len(near), brute.sha(",".join(sorted(near)))), (i, t)
        assert got[i].n_hit == brute.decontaminate(t, bench)[1]
        found += len(near)
    assert found > 30


# ---------------------------------------------------------------- 9
def test_line_dedup_equals_brute_force(spark):
    texts = corpus(8) + corpus(9)[5:] + ["same " * 30 + "\n\nx\n" + "same " * 30, "s1 s2\ns3\n" * 12]
    got = {x.doc_id: x for x in dedup_lines(frame(spark, texts), keep=("t",)).collect()}
    for i, gone in brute.line_dedup(list(enumerate(texts)), 25).items():
        text, x = texts[i], got[i]
        lines = text.split("\n") if text is not None else []
        assert (x.n_lines, x.n_removed) == (len(lines), len(gone)), i
        kept = None if text is None else "\n".join(y for k, y in enumerate(lines) if k not in gone)
        assert x.kept_text == kept and x.t == "clash", i
    assert dedup_lines(empty(spark)).count() == 0
    long = "word " * 40
    twins = dedup_lines(frame(spark, [long, long, long], [None, 2, 2])).collect()
    assert [x.n_removed for x in sorted(twins, key=lambda x: x.doc_id or 0)] == [0, 1, 1]


# ---------------------------------------------------------------- 10
@pytest.mark.parametrize("target,want", [
    ("../z/p.html", "http://a.org/x/z/p.html"), ("./q", "http://a.org/x/y/q"), ("q/../r", "http://a.org/x/y/r"),
    ("?b=2", "http://a.org/x/y/p.html?b=2"), ("../../../../up", "http://a.org/up"), ("..", "http://a.org/x/"),
    (".", "http://a.org/x/y/"), ("/a/./b/../c?x=../d", "http://a.org/a/c?x=../d"), ("//b.org/./k", "http://b.org/k"),
    ("https://c.org/a/../b#f", "https://c.org/b#f"), ("plain.html", "http://a.org/x/y/plain.html"), ("a..b", "http://a.org/x/y/a..b")])
def test_relative_targets_are_resolved(spark, target, want):
    from urllib.parse import urljoin, urlsplit

    from changeflow.llm.common import settle
    from changeflow.llm.url_filter import _resolved, _without_dots
    row = spark.createDataFrame([("http://a.org/x/y/p.html?a=1", target)], "url string, target string")
    got = settle(row, full=_resolved(F.col("target"), F.col("url"))).select(_without_dots(F.col("full"))).first()[0]
    # urljoin leaves the dot segments of a target with a host of its own; joined to its own path it drops them (RFC 3986, 5.2.2).
    joined = urljoin("http://a.org/x/y/p.html?a=1", target)
    assert got == want == urljoin(joined, urlsplit(joined)._replace(scheme="", netloc="").geturl())


def test_relative_links_carry_decisions(spark):
    rows = [(1, "http://a.org/x/", '<link rel="canonical" href="../z/p.html">'), (2, "http://a.org/z/p.html", ""),
            (3, "http://a.org/z/p.html", '<link rel="canonical" href="http://k.net/">'),
            (4, "http://b.org/x/", '<link rel="canonical" href="?b=2">'),
            (5, "http://b.org/x/?b=2", '<meta http-equiv=refresh content="0;url=//k.net/">')]
    got = {r.page_id: r.verdict for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == dict.fromkeys(range(1, 6), "block")


def test_url_sql_follows_links_as_the_operator_does(spark):
    import duckdb
    import pandas as pd

    from changeflow.llm import oracles
    r = random.Random(17)
    hosts = ["a.org", "B.org", "x.net", "en.example.net", "example.com", "c.io", "d.io", "e.io", "f.io"]
    paths = ["", "/", "/x/", "/x/y.html", "/de/z", "/fr/", "/en/k", "/x/?q=1", "/x/y.html?b=2#f"]
    targets = ["../z", "./y.html", "?b=2", "/de/z", "//d.io/x/", "http://x.net/", "https://f.io/x/y.html#g", "mailto:a@b", "#top", "..",
               "/x/?q=1&amp;r=2", "HTTP://C.io/fr/", "y.html", "http://en.example.net/en/k"]
    forms = ['<link rel="canonical" href="{}">', "<LINK href='{}' rel=canonical>", '<meta http-equiv="Refresh" content="0; url={}">',
             '<link rel="stylesheet" href="{}">', "{}"]
    rows = [(k, r.choice(["http://", "https://", "HTTP://"]) + r.choice(hosts) + r.choice(paths),
             " ".join(r.choice(forms).format(r.choice(targets)) for _ in range(r.choice([0, 0, 1, 2])))) for k in range(120)]
    rows += [(500, None, None), (501, "no scheme", "<link rel=canonical href=/a>"), (502, "http:///p", ""), (503, "http://c.io", None)]
    got = sorted(map(tuple, filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()))
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    want = con.sql(f'SELECT page_id, host, path, rule, verdict, "by" FROM ({oracles.filtered_urls()})').fetchall()
    assert got == sorted(want) and sum(x[-1] == "alias" for x in got) > 10


def test_url_rules_and_aliases(spark):
    pages = [
        (0, "http://a.net/x", None), (1, "https://WWW.Example.NET/en/1?q#f", ""), (2, "http://www.example.net/En/1", "<p>"),
        (3, None, None), (4, "no scheme", "<link rel=canonical href='http://a.net/x'>"), (5, "http://x.net", ""),
        (6, "http://sub.example.com/de/q", None), (7, "http://org/fr/", None), (8, "http://notorg/fr/", None),
        (9, "http://mirror.io/p", '<link href="http://b.net/y" rel="canonical">'),
        (10, "http://third.io/p", '<meta http-equiv="refresh" content="0; url=http://mirror.io/p#z">'),
        (11, "http://free.io/a", '<link rel="canonical" href="//example.net/en/ok">'),
        (12, "http://free.io/b", '<link rel="canonical" href="/a"><link rel="canonical" href="http://c.net/">'),
        (13, "https://mirror.io/p", None), (14, "http://lone.io/", '<link rel="stylesheet" href="http://a.net/x">'),
        (15, "http://lone.io/dir/f", '<link rel="canonical" href="g">'), (16, "http://lone.io/dir/g", None)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.by) for r in filter_urls(df).collect()}
    assert got[0] == ("a.net", "/x", "net/", "block", "rule")
    assert got[1] == ("www.example.net", "/en/1", "example.net/en/", "allow", "rule")
    assert got[2][2:4] == ("net/", "block")
    assert got[3] == got[4] == ("", "", None, "allow", "default")
    assert got[5] == ("x.net", "", None, "allow", "default")
    assert got[6][2:4] == ("example.com/de/", "block") and got[7][2:4] == ("org/fr/", "allow")
    assert got[8][2] is None
    assert got[9][2:] == got[10][2:] == got[13][2:] == (None, "block", "alias")
    assert got[11][2:] == got[12][2:] == (None, "allow", "alias")       # an allowed alias goes before a blocked one
    assert got[14][3:] == got[15][3:] == ("allow", "default")
    logged = spark.createDataFrame([("http://lone.io/dir/g", "http://a.net/z")], "url string, target string")
    more = {r.page_id: r.verdict for r in filter_urls(df, redirects=logged).collect()}
    assert (more[15], more[16], more[14]) == ("block", "block", "allow")
    custom = filter_urls(df, rules=[Rule("block", "io", "/")]).where("page_id = 11").first()
    assert (custom.rule, custom.verdict) == ("io/", "block")
    assert filter_urls(df.limit(0)).count() == 0



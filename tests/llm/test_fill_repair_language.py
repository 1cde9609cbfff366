"""Fill-in-middle, conversation repair and language identification against plain versions."""

import hashlib
import random
import re

import brute
import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from changeflow.llm import conversation_repair as CR
from changeflow.llm import fill_middle as FM
from changeflow.llm import language_id as LI
from changeflow.llm import queries
from changeflow.llm.common import materialize


# ---------------------------------------------------------------- fill-in-middle
def filled(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digits[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return len(units), form, len(pre), len(mid), out


TEXTS = [None, "", "\n", "one", "one\n", "\n\n\n", "a<\n<P\nS>b\n", "has <M> in it\nand more", "x<P>y", "é\r\nü z\n𝄞𝄞",
         "<S\n><\n<M\n", "line\n" * 4000, "q" * 3_000_000, "same\ntext\n", "same\ntext\n"]


def test_fill_middle_equals_plain_version_and_restores(spark):
    rows = [(None if k == 4 else k // 2, t, "clash", "clash") for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string")
    made = FM.fill_middle(docs)
    got = sorted(made.collect(), key=str)
    want = sorted((filled(i, t) for i, t, _, _ in rows), key=str)
    assert sorted(((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == want
    assert all(r.output_sha256 == brute.sha(r.output) for r in got)
    back = FM.restore(made, carry=("n",)).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for t in TEXTS)
    assert all(r.restored_sha256 == brute.sha(r.text) for r in back)
    assert FM.restore(FM.fill_middle(docs.limit(0))).count() == 0


def test_pieces_describe_the_output(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in FM.fill_middle(docs, unit="char", seed=3).collect():
        buffers = (TEXTS[r.doc_id] or "", "<P><S><M>")
        assert "".join(buffers[p.buffer][p.start:p.start + p.length] for p in r.pieces) == r.output
    assert {r.form for r in FM.fill_middle(docs, rate=0).collect()} == {"plain"}
    with pytest.raises(ValueError):
        FM.fill_middle(docs, unit="word")


def test_bytes_that_are_no_text_come_back(spark):
    raw = spark.sql("SELECT 1L AS doc_id, cast(X'61FF0A62C30A' AS string) AS text")
    made = FM.fill_middle(raw, unit="char")
    assert made.first().n == 6
    assert bytes(FM.restore(made).select(F.col("text").cast("binary")).first()[0]) == bytes.fromhex("61FF0A62C30A")


# ---------------------------------------------------------------- conversation repair
def turns_of(r, n):
    """Turns with repeats, gaps, ties, blanks and other roles."""
    out = []
    for k in range(n):
        role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
        text = r.choice(["Fine.", "Yes!", f"Word {k}.", "cut", "  ", "", None, "Fine.", f"cut {k}"])
        turn = r.choice([k, k, k, k + 1, None, 3 * k])
        out.append((turn, role, text))
        if r.random() < 0.2:
            out.append(out[-1])
    return out


def plain(rows):
    return brute.conversation([(t, " " if role is None else role, " " if text is None else text) for t, role, text in rows])


@pytest.mark.parametrize("block", [1, 2, 5, 24])
def test_moves_of_blocks_make_the_cheapest_and_least_audit(block, monkeypatch):
    monkeypatch.setattr(CR, "BLOCK", block)
    r = random.Random(block)
    for _ in range(150):
        turns = [(r.choice("uuaas") if r.random() < 0.9 else r.choice(["t", ""]),
                  r.choice([None, None, None, "truncated", "blank", "duplicate"])) for _ in range(r.randint(0, 12))]
        s = CR.Stretch()
        for k, (initial, fault) in enumerate(turns):
            s.add(k, initial, 1, fault)
        assert CR.outcome(s.all_moves(whole=r.random() < 0.5)) == brute.repaired(turns), turns


def test_repair_equals_plain_version(spark, monkeypatch):
    r = random.Random(11)
    talks = {i: turns_of(r, r.choice([0, 1, 2, 5, 9, 60])) for i in range(40)} | {None: turns_of(r, 7)}
    talks[7] = turns_of(r, 300)                                          # goes over many ranges and blocks
    talks[8] = [(1, "user", "Same.")] * 50 + [(2, "assistant", "Same.")] * 3
    rows = [(i, *t, "clash", "clash") for i, found in talks.items() for t in found]
    r.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, copies string")
    ids = spark.createDataFrame([(i,) for i in talks], "conv_id long")
    got = {x.conv_id: tuple(x)[1:] for x in CR.repair_report(turns, ids).collect()}
    want = {i: plain(found) if found else (0, 0, 0, 0, 0, 0, "", brute.sha("")) for i, found in talks.items()}
    assert got == want
    spread = CR.ordered_turns(turns).repartition(13)                     # a conversation's stretches in several tasks
    monkeypatch.setattr(CR, "BLOCK", 4)
    report = materialize(CR.audits(spread), "test-audits")
    assert {x.conv_id: tuple(x)[1:] for x in report.collect()} == {i: w[:-1] for i, w in want.items() if talks[i]}
    turns_out = CR.repaired_turns(spread, report).orderBy("conv_id", "seq").collect()
    lines = {}
    for x in turns_out:
        lines.setdefault(x.conv_id, []).append(f"{x.role}:{x.text}")
    assert {i: brute.sha("\n".join(lines.get(i, []))) for i in want} == {i: w[-1] for i, w in want.items()}


def test_repair_of_nothing_and_of_text_ids(spark):
    none = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert CR.repair_report(CR.damage(none), none).count() == 0
    one = spark.createDataFrame([("x", 0, "user", "Hi."), ("x", 1, "assistant", "Yes.")], none.schema)
    assert [tuple(x) for x in CR.repair_report(one, one).collect()] == [
        ("x", 0, 0, 0, 0, 0, 0, "KK", brute.sha("user:Hi.\nassistant:Yes."))]


def test_damage_follows_the_hash(spark):
    import zlib
    rows = [(c, t, "assistant", f"Line {t}. Done!") for c in range(8) for t in range(12)] + [(None, None, None, None)]
    out = CR.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


# ---------------------------------------------------------------- language identification
def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = queries.op13_language_id(spark, SF0001).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def plain_prediction(train, text):
    """Language by the same counts, written as dictionaries of texts."""
    import math
    import unicodedata

    def words(t):
        found, now = [], ""
        for ch in (t or "").lower():
            kind = unicodedata.category(ch)[0]
            if kind == "L" or now and (kind == "M" or ch in "'’"):
                now += ch
            else:
                found, now = found + [now] * bool(now), ""
        return found + [now] * bool(now)

    def pieces(w, n):
        if n == 0:
            return [w]
        if n == 1:
            return list(w)
        return [f"<{w}>"[k:k + n] for k in range(len(w) + 3 - n)]

    langs = sorted({x for x, t in train if t}, key=lambda x: (-sum(len(t) for y, t in train if y == x and t), x))
    count = {}
    for lang, t in train:
        for w in words(t):
            for n in range(6):
                for g in pieces(w, n):
                    count[lang, n, g] = count.get((lang, n, g), 0) + 1
    total = {(x, n): sum(c for (y, m, _), c in count.items() if (y, m) == (x, n)) for x in langs for n in range(6)}
    everywhere = {}
    for (_, n, g), c in count.items():
        everywhere[n, g] = everywhere.get((n, g), 0) + c
    known = {k for k, c in everywhere.items() if c >= 2}
    size = {n: sum(1 for m, _ in known if m == n) for n in range(6)}
    score = lambda x, n, g: math.log((count.get((x, n, g), 0) + 0.5) / (total[x, n] + 0.5 * max(1, size[n])))
    sums, n_words = dict.fromkeys(langs, 0.0), 0
    if not words(text) or not langs:
        return "und", 0.0
    for w in words(text):
        for n in (0, 5, 4, 3, 2, 1):
            hits = [g for g in pieces(w, n) if (n, g) in known]
            if hits:
                for x in langs:
                    sums[x] += sum(score(x, n, g) for g in hits) / len(hits)
                n_words += 1
                break
    best = max(langs, key=lambda x: sums[x])
    return best, 1 / sum(math.exp((sums[x] - sums[best]) / max(1, n_words)) for x in langs)


def test_model_equals_plain_version(spark):
    train = [("en", "The cat sat on the mat. The dog's bone is the best."), ("de", "Die Katze saß auf der Matte und der Hund auch."),
             ("de", "Der Hund und die Katze sind da."), ("", "xyzzy plugh xyzzy"), ("en", None), (None, "pas appris du tout"),
             ("en", "12 34"), ("fr", "Le chat est sur le lit, l’eau est là."), ("fr", "Le chat est sur le lit, l’eau est là.")]
    asked = ["the cat", "Katzen und Hunde", "une eau là", "xyzzy", "qqqq jjjj", "日本語", "12 345 --- ", "", None, "The cat der chat",
             "e" * 3000, "dogs’ bones\nmatten", "ΑΒΓ the", "²³ ½ _"]
    rows = [(k, t, x, True) for k, (x, t) in enumerate(train)] + [(None if k == 3 else 100 + k, t, "zz", False) for k, t in enumerate(asked)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, train boolean").withColumn("score", F.lit("clash"))
    out = LI.language_ids(docs, held=~F.col("train")).where("held_out").collect()
    by_text = {k: plain_prediction([x for x in train if x[0] is not None], t) for k, t in zip([None if k == 3 else 100 + k for k in range(len(asked))], asked)}
    assert len(out) == len(asked)
    for r in out:
        lang, score = by_text[r.doc_id]
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4, (r, lang, score)


def test_languages_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert LI.language_ids(docs).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None), (2, None, None)], docs.schema)
    assert {(r.lang_pred, r.score) for r in LI.language_ids(unlabelled).collect()} == {("und", 0.0)}


def test_slices_end_at_blanks(monkeypatch):
    text = "Vier kurze Wörter hier und da " * 20
    whole = LI.words_of(text)
    monkeypatch.setattr(LI, "SLICE", 7)
    assert LI.words_of(text) == whole

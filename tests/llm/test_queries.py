"""The registered queries over the given tables: against DuckDB, or against the plain versions."""

import os

import brute
import pytest
from conftest import SF0001

import __spark_entry__ as E
import corpus_pipeline
from changeflow.llm import oracles, queries
from tools.check_oracle import compare, duck

SQL = sorted(queries.oracle_sql())


def rows_of(spark, name="documents"):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/{name}.parquet").collect()]


def test_all_are_registered():
    names = set(E.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


@pytest.mark.parametrize("name", SQL)
def test_matches_sql(spark, name):
    msg = compare(spark, duck(SF0001), name, queries.queries()[name], queries.oracle_sql()[name], SF0001)
    assert ": OK" in msg, msg


def test_op1_matches_brute_force(spark):
    rows = rows_of(spark)
    got = {r.doc_id: r for r in queries.op1_suffix_dedup(spark, SF0001).collect()}
    assert len(got) == len(rows)
    import hashlib
    for (i, _), (n, gone, spans, kept) in zip(rows, brute.suffix_dedup([t for _, t in rows], 400)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, spans, hashlib.sha256(kept).hexdigest())


def test_op3_matches_brute_force(spark):
    turns = spark.read.parquet(f"{SF0001}/conversations.parquet").orderBy("conv_id", "turn").collect()
    want = {}
    for r in turns:
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op3_chat_format(spark, SF0001).collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        loss = "".join(t for role, t in v if role == "assistant")
        assert (got[k].n_turns, got[k].loss_chars) == (len(v), len(loss))
        assert got[k].turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for role, t in v))
        assert got[k].loss_sha256 == brute.sha(loss)
        assert got[k].formatted_chars > sum(len(t) for _, t in v)


def test_op5_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in queries.op5_lm_scores(spark, SF0001).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_op6_matches_brute_force(spark):
    rows = rows_of(spark)
    fps, groups = brute.simhash_groups(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash_groups(spark, SF0001).collect()}
    assert got == {i: (f"{f:016x}", g) for (i, _), f, g in zip(rows, fps, groups)}


# ---------------------------------------------------------------- the pipeline
def as_table(con, name, df, scratch):
    path = os.path.join(scratch, name)
    df.write.parquet(path)
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")


def test_pipeline_equals_stage_by_stage(spark, scratch):
    """Each stage on its own input, against SQL or brute force; run() gives the last stage's rows."""
    con = duck(SF0001)
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns = docs.columns
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    for k, (name, stage) in enumerate(stages):
        as_table(con, f"s{k}", docs, scratch)
        before = {r.doc_id: r.asDict() for r in docs.collect()}
        out = stage(spark, docs, SF0001)
        path = os.path.join(scratch, f"out{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r.asDict() for r in docs.collect()}
        assert len(after) == docs.count() and docs.columns[:len(columns)] == columns
        if name == "quality_rules":
            want = {d for d, kept in con.sql(f"SELECT doc_id, kept FROM ({oracles.quality_rules('s0')})").fetchall() if kept}
            clean = {d: "\n".join(x) for d, _, x in con.sql(oracles.cleaned_texts("s0")).fetchall()}
            changed = {d for d in want if clean[d] != before[d]["text"]}
            assert after == {d: before[d] | ({"text": clean[d], "n_chars": len(clean[d])} if d in changed else {}) for d in want}
            assert changed and len(changed) < len(want)
        elif name == "line_dedup":
            for d, gone in brute.line_dedup([(d, r["text"]) for d, r in before.items()], 25).items():
                text = "\n".join(x for i, x in enumerate(before[d]["text"].split("\n")) if i not in gone)
                if gone and not text.split():
                    assert d not in after
                else:
                    assert after[d] == before[d] | ({"text": text, "n_chars": len(text)} if gone else {})
        elif name == "near_duplicates":
            rows = [(d, r["text"]) for d, r in before.items()]
            _, groups = brute.simhash_groups(rows)
            assert after == {d: before[d] for d in set(groups)}
        elif name == "decontamination":
            sql = oracles.decontaminated("s3")
            want = {d for d, bad in con.sql(f"SELECT doc_id, contaminated FROM ({sql})").fetchall() if not bad}
            assert after == {d: before[d] for d in want}
        else:
            sql = f"SELECT doc_id, copies, taken FROM ({oracles.mix_sources('s4')}) WHERE copies > 0"
            want = {d: (c, t) for d, c, t in con.sql(sql).fetchall()}
            assert {d: (r["copies"], r["taken"]) for d, r in after.items()} == want
            assert all({c: r[c] for c in columns} == before[d] for d, r in after.items())
    whole = {r.doc_id: r.asDict() for r in corpus_pipeline.run(spark, SF0001).collect()}
    assert whole == after


def test_pipeline_stages_on_odd_tables(spark, scratch):
    schema = "doc_id long, text string, source string, _row string, kept string, copies string, _key string"
    long = "Some words that are written here stand for one plain line of text that goes on and on for a while. "
    rows = [(None, None, None, "a", "b", "c", "d"), (1, "", "s", "a", "b", "c", "d"), (1, "", "s", "a", "b", "c", "d"),
            (2, long, None, "a", "b", "c", "d"), (2, long, None, "a", "b", "c", "d"), (3, "x " * 30, "s", "a", "b", "c", "d")]
    full, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    sizes = {"quality_rules": 2, "line_dedup": 6, "near_duplicates": 3, "decontamination": 6, "mixing": None}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, full, SF0001)
        got = out.collect()
        assert out.columns[:7] == full.columns, name
        assert all((r._row, r["kept"], r.copies, r._key) == ("a", "b", "c", "d") for r in got), name
        assert sizes[name] in (None, len(got)), (name, len(got))
        assert stage(spark, none, SF0001).count() == 0

"""Chat formatting, exact dedup and WARC archives against plain Python."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchlake.llm import chat_format, exact_dedup, warc
from matchlake.llm.scratch import stored
from matchlake.session import scratch_path

TURN = "conv_id long, turn long, role string, text string"
NASTY = ["", "</s>", "<s>[INST] x [/INST]</s>", "\\", "\\l\\b\\o", "<<SYS>>\n\n<</SYS>>\n", "a\nb", " <", "[", "<</TURN>>", "é😀", "[INST", "\\</s>", "x" * 70_000, None]


def test_round_trip_of_control_strings(session):
    roles = ["user", "assistant", "system", "tool</s>", None]
    rows = [(i, t, roles[(i + t) % 5], NASTY[(3 * i + 7 * t) % len(NASTY)]) for i in range(40) for t in range(6)]
    written = stored(chat_format.conversations(chat_format.format_turns(session.createDataFrame(rows, TURN))), "test-chat")
    got = {r.conv_id: r for r in written.withColumn("turns", chat_format.parse(F.col("formatted"))).collect()}
    for i in range(40):
        want = [(r or "", t or "") for c, _, r, t in rows if c == i]
        assert [(t.role, t.text) for t in got[i].turns] == want
        segments = got[i].segments
        assert "".join(s.text for s in segments) == got[i].formatted
        assert sum(s.learn for s in segments) == sum(r == "assistant" for r, _ in want)


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("<>/[]\\lobsINSTYROLEU \n"), max_size=25), min_size=1, max_size=8))
def test_round_trip_of_any_text(session, texts):
    rows = [(1, i, ["user", "assistant", "other"][i % 3], t) for i, t in enumerate(texts)]
    written = chat_format.conversations(chat_format.format_turns(session.createDataFrame(rows, TURN)))
    turns = written.select(chat_format.parse(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in turns] == [(r, t) for _, _, r, t in rows]


def test_state_machine(session):
    said = {1: "ua", 2: "suaua", 3: "au", 4: "uu", 5: "sa", 6: "u", 7: "uas", 8: "ux"}
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    rows = [(c, i, names[r], "t") for c, turns in said.items() for i, r in enumerate(turns)]
    got = chat_format.conversations(chat_format.format_turns(session.createDataFrame(rows, TURN))).collect()
    assert {r.conv_id for r in got if r.valid} == {1, 2, 6}
    empty = session.createDataFrame([], TURN)
    assert chat_format.conversations(chat_format.format_turns(empty)).isEmpty()


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_exact_groups(session, odd_documents, documents, no_documents, support):
    copies = session.range(400).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'hot', concat('t', id div 4))").alias("text"))
    for docs in (odd_documents, documents, copies, no_documents):
        given_ = docs.collect()
        groups = {}
        for r in given_:
            groups.setdefault(r.text or "", []).append(r.doc_id)
        got = exact_dedup.exact_groups(docs, support).collect()
        want = sorted(str((d, max((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()))
                      for t, ids in groups.items() for d in ids)
        assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_archives(session):
    long_ = "<p>" + "ü" * 600
    rows = [(1, "http://a", "x"), (2, None, None), (3, "http://b?q=é\r\n x", long_), (4, "http://c", long_), (5, "", long_), (5, "", long_),
            (None, "http://d", long_), (6, "http://e", "short"), (7, "http://f", "short"), (8, "http://g", "y" * 3_000_000), (9, "h", ""), (None, None, "z" * 2000)]
    pages = session.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, digest string")
    folder = scratch_path(session, "test-warc")
    index = warc.write_archives(pages, folder, archive_bytes=2000)
    assert index.count() == len(rows)
    got = warc.read_records(index, folder, range_bytes=5000, gap_bytes=10).collect()
    raw = [(p, (h or "").encode()) for p, _, h in rows]
    want = []
    for p, h in raw:
        keeper = max((q for q, g in raw if g == h and q is not None), default=None)
        revisit = len(h) >= 1000 and keeper is not None and p != keeper
        want.append((p, len(h), hashlib.sha1(h).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == sorted(map(str, want))
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")
    some = warc.read_records(index.filter("page_id in (1, 6, 8)"), folder).collect()
    assert sorted(r.page_id for r in some) == [1, 6, 8]
    assert warc.write_archives(pages.limit(0), scratch_path(session, "test-warc")).isEmpty()


def test_more_than_one_task_reads(session):
    """The index rows are few bytes, the records they name are not."""
    pages = session.range(200).select(F.col("id").alias("page_id"), F.lit("http://a").alias("url"), F.concat_ws(" ", F.transform(
        F.sequence(F.lit(1), F.lit(200)), lambda k: F.sha1(F.concat_ws("-", k, "id").cast("binary")))).alias("html"))
    folder = scratch_path(session, "test-warc")
    read = warc.read_records(warc.write_archives(pages, folder), folder, range_bytes=200_000)
    assert read.count() == 200
    assert read.select(F.spark_partition_id()).distinct().count() > 1


def test_pages_stay_where_they_are_read(session):
    """The digests of copies go to the pages, not the pages to the digests, unless there are too many of them."""
    pages = session.range(60).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.concat(F.lit("p"), F.col("id") % 20), 1000).alias("html"))
    name, before = "spark.sql.autoBroadcastJoinThreshold", session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set(name, "-1")
    try:
        few, many = warc.plan_records(pages, 1000), warc.plan_records(pages, 1000, broadcast_bytes=0)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (few, many)]
        assert ["SortMergeJoin" in plan for plan in plans] == [False, True]
        assert sorted(few.collect()) == sorted(many.collect())
        assert few.filter("refers_to = page_id % 20 + 40").count() == 40
    finally:
        session.conf.set(name, before)


def test_no_window_over_equal_digests(session):
    plan = exact_dedup.exact_groups(session.range(50).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))._jdf.queryExecution().toString()
    assert "Window" not in plan

import base64
import hashlib
import os
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import LONG, with_clashes
from statutegraph.llm import chat, urls, warc

# ---------------------------------------------------------------- WARC

PAGES = [
    (1, "http://a.example/x", "<p>same</p>"),
    (2, None, None),
    (3, "http://b.example/\r\nX: y", "<p>same</p>"),
    (4, "http://c.example/é", ""),
    (5, "http://d.example", LONG + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (1, "http://a.example/x", "<p>same</p>"),
    (-8, "http://e.example", "é漢😀"),
    (None, "http://f.example", "only here"),
]


def pages(spark, rows=PAGES, clashing=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return with_clashes(df) if clashing else df


def brute_warc(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        group = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(group, default=None)
        revisit = i != first
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return Counter(out)


def test_pieces_of_a_plain_file_parse_each_header_about_once(tmp_path, monkeypatch):
    writer = warc.WarcWriter({"path": str(tmp_path)}, True)
    odd = [b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"WARC/1.0\nWARC-Type: info\n\nno length\n"]
    body = [writer.record(r) for r in records(3000, 200)]
    body += [writer.record(records(1, 0, payload="x\r\n\r\nWARC/1.1\r\nno header y", payload_bytes=29)[0])]
    (tmp_path / "a.warc").write_bytes(b"".join(x + (odd[i % 2] if i % 500 == 7 else b"") for i, x in enumerate(body)))
    seen, real = [], warc.read_headers
    monkeypatch.setattr(warc, "read_headers", lambda f: seen.append(1) or real(f))
    whole = [r[:6] for r in warc.WarcReader({"path": str(tmp_path)}).read(warc.Pieces([(str(tmp_path / "a.warc"), 0, None)]))]
    n = len(seen)
    for size in (1000, 40_000, 333_333):
        seen.clear()
        reader = warc.WarcReader({"path": str(tmp_path), "partitionbytes": str(size)})
        parts = reader.partitions()
        assert [r[:6] for p in parts for r in reader.read(p)] == whole and len(parts) > 2
        assert len(seen) <= n + 3 * len(parts)


@pytest.mark.parametrize("clashing", [False, True])
def test_archive_gives_every_page_back(spark, clashing):
    got = warc.archived_pages(pages(spark, clashing=clashing)).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute_warc(PAGES)
    assert all(r.intact is (True if r.record_type == "response" else None) for r in got)


def test_archive_of_nothing(spark):
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_small_payloads_are_responses(spark):
    kinds = {(r.record_id, r.record_type) for r in warc.page_records(pages(spark), min_bytes=5).collect()}
    assert ("urn:page:3", "revisit") in kinds and ("urn:page:4", "response") in kinds


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_predicates_on_headers_reach_the_reader(spark, tmp_path, compression):
    path = str(tmp_path / "w")
    warc.write_archive(warc.page_records(pages(spark)).repartition(3), path, compression)
    assert all(f.endswith(".warc" if compression == "none" else ".warc.gz") for f in os.listdir(path) if f.startswith("part"))
    every = warc.read_archive(spark, path)
    assert every.count() == len(PAGES)
    found = every.filter("record_type = 'revisit' and refers_to = 'urn:page:1'")
    assert [r.target_uri for r in found.collect()] == ["http://b.example/%0D%0AX: y"]
    both = every.filter(F.col("record_id").isin("urn:page:-8", "urn:page:5")).select("record_id", "payload").collect()
    assert {r.record_id: bytes(r.payload).decode() for r in both} == {"urn:page:-8": "é漢😀", "urn:page:5": PAGES[4][2]}
    bare = warc.read_archive(spark, path, payload=False)
    assert bare.filter("payload is not null").count() == 0 and Counter(r.payload_bytes for r in bare.collect()) == Counter(len((h or "").encode()) for _, _, h in PAGES)


def test_reader_skips_payloads_it_does_not_want(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan

    writer = warc.WarcWriter({"path": str(tmp_path)}, False)
    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": None, "date": "d", "refers_to": None, "payload_digest": hashlib.sha1(b"abc").hexdigest(), "payload_bytes": 3, "payload": "abc"}
    (tmp_path / "a.warc").write_bytes(writer.record(row) + writer.record(row | {"record_id": "urn:page:2", "record_type": "revisit", "refers_to": "urn:page:1", "payload": None}))
    reader = warc.WarcReader({"path": str(tmp_path)})
    kept = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 1)]))
    assert kept == [GreaterThan(("payload_bytes",), 1)]
    read, row_of = [], reader.row
    reader.row = lambda *a: read.append(a) or row_of(*a)
    (part,) = reader.partitions()
    assert len(list(reader.read(part))) == 1 and len(read) == 1


def test_files_are_packed_into_partitions(tmp_path):
    for i in range(10):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * 40)
    parts = warc.WarcReader({"path": str(tmp_path), "partitionbytes": "100"}).partitions()
    assert [len(p.pieces) for p in parts] == [2] * 5
    (tmp_path / "_job-x").mkdir()
    (tmp_path / "_job-x" / "z.warc").write_bytes(b"x" * 40)
    (tmp_path / "big.warc").write_bytes(b"x" * 450)
    parts = warc.WarcReader({"path": str(tmp_path), "partitionbytes": "100"}).partitions()
    big = [p.pieces[0][1:] for p in parts if p.pieces[0][0].endswith("big.warc")]
    assert big == [(0, 100), (100, 200), (200, 300), (300, 400), (400, None)] and len(parts) == 10


class Row(dict):
    def asDict(self):
        return dict(self)


def records(n, size=0, **more):
    made = []
    for i in range(n):
        payload = f"{i} " + "x" * (size * (i % 5))
        digest = hashlib.sha1(payload.encode()).hexdigest()
        made.append(Row(record_id=f"urn:page:{i}", record_type="response", target_uri=None, date="d", refers_to=None, payload_digest=digest, payload_bytes=len(payload), payload=payload) | more)
    return [Row(r) for r in made]


def read_all(path, **options):
    reader = warc.WarcReader({"path": str(path)} | options)
    return [r for p in reader.partitions() for r in reader.read(p)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("piece", ["50", "300", "5000", "100000"])
def test_large_files_are_read_in_pieces(tmp_path, compression, piece):
    writer = warc.WarcWriter({"path": str(tmp_path), "compression": compression}, False)
    rows = records(60, 40)
    rows[7]["payload"] = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 20
    rows[7] |= {"payload_bytes": len(rows[7]["payload"]), "payload_digest": hashlib.sha1(rows[7]["payload"].encode()).hexdigest()}
    writer.commit([writer.write(map(Row, rows))])
    got = read_all(tmp_path, partitionbytes=piece)
    assert [r[0] for r in sorted(got, key=lambda r: int(r[0].split(":")[2]))] == [r["record_id"] for r in rows]
    assert all(r[7] for r in got)


def test_one_gzip_member_of_many_records_is_read_once(tmp_path):
    import gzip

    writer = warc.WarcWriter({"path": str(tmp_path)}, False)
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(b"".join(map(writer.record, records(50, 300)))))
    assert Counter(r[0] for r in read_all(tmp_path, partitionbytes="200")) == Counter(f"urn:page:{i}" for i in range(50))


def test_odd_archives_cost_no_more_than_what_is_odd(tmp_path):
    writer = warc.WarcWriter({"path": str(tmp_path)}, False)
    a, b, c = map(writer.record, records(3, 10))
    http = b"HTTP/1.1 200 OK\r\nno colon here\r\nContent-Length: many\r\nX: 1\r\nX: 2\r\n\r\nbody"
    odd = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <odd>\r\nno colon\r\nX-Name: caf\xe9\r\n folded\r\nX-Twice: 1\r\nx-twice: 2\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(http)
    bad_length = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <bad>\r\nContent-Length: lots\r\n\r\nsome text\r\n\r\n"
    no_head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <headless>\r\nContent-Type: application/http\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    plain = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <plain>\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(b"garbage\n" + a + odd + http + b"\r\n\r\n" + bad_length + b + no_head + plain + c + b"WARC/1.0\r\nWARC-Record-ID: <cut>\r\nContent-Length: 99\r\n\r\nbroken off")
    for payload in ("true", "verify", "false"):
        got = {r[0]: r for r in read_all(tmp_path, payload=payload)}
        assert set(got) == {"urn:page:0", "odd", "bad", "urn:page:1", "headless", "plain", "urn:page:2", "cut"}
        assert got["odd"][5] == 4 and got["odd"][8]["x-twice"] == "1, 2" and got["odd"][8]["x-name"].endswith("folded")
        assert got["bad"][5] is None and got["bad"][7] is False and got["plain"][5] == 3
        assert (got["odd"][9], got["plain"][9]) == ((b"body", b"xyz") if payload == "true" else (None, None))
        assert got["urn:page:1"][7] is (None if payload == "false" else True)


def test_skipped_payloads_are_not_read(tmp_path):
    writer = warc.WarcWriter({"path": str(tmp_path)}, False)
    big = records(3, 0, payload="y" * 3_000_000, payload_bytes=3_000_000)
    (tmp_path / "a.warc").write_bytes(b"".join(map(writer.record, big)))
    reader, taken = warc.WarcReader({"path": str(tmp_path), "payload": "false"}), []

    class Counted:
        def __init__(self, path):
            self.file = open(path, "rb", buffering=0)

        def __getattr__(self, name):
            return getattr(self.file, name)

        def read(self, n=-1):
            taken.append(len(data := self.file.read(n)))
            return data

        def readline(self):
            taken.append(len(data := self.file.readline()))
            return data

    assert [r[5] for r in reader.records(Counted(tmp_path / "a.warc"))] == [3_000_000] * 3 and sum(taken) < 50_000


def test_predicates_of_every_kind(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archive(warc.page_records(pages(spark)), path)
    every = warc.read_archive(spark, path)
    rows = every.collect()
    for text, want in {
        "target_uri is null": lambda r: r.target_uri is None,
        "target_uri is not null": lambda r: r.target_uri is not None,
        "target_uri like 'http://a%'": lambda r: r.target_uri is not None and r.target_uri.startswith("http://a"),
        "target_uri like '%example'": lambda r: r.target_uri is not None and r.target_uri.endswith("example"),
        "target_uri like '%/%.example/%'": lambda r: r.target_uri is not None and ".example/" in r.target_uri,
        "target_uri > 'http://c'": lambda r: r.target_uri is not None and r.target_uri > "http://c",
        "target_uri <= 'http://c.example/é'": lambda r: r.target_uri is not None and r.target_uri <= "http://c.example/é",
        "not (record_type = 'revisit')": lambda r: r.record_type != "revisit",
        "refers_to <=> null": lambda r: r.refers_to is None,
        "refers_to <> 'urn:page:1'": lambda r: r.refers_to is not None and r.refers_to != "urn:page:1",
        "not (target_uri like 'http://a%')": lambda r: r.target_uri is not None and not r.target_uri.startswith("http://a"),
        "target_uri in ('http://a.example/x', null)": lambda r: r.target_uri == "http://a.example/x",
    }.items():
        assert Counter(r.record_id for r in every.filter(text).collect()) == Counter(r.record_id for r in rows if want(r)), text


def test_a_task_that_ran_twice_counts_once(tmp_path):
    """Appending to an archive that has records: a lost task's files and a repeated task's go, what was there stays."""
    before = warc.WarcWriter({"path": str(tmp_path)}, False)
    before.commit([before.write(iter(records(2)))])
    writer = warc.WarcWriter({"path": str(tmp_path)}, False)
    writer.write(iter(records(3, record_id="lost")))
    good = writer.write(iter(records(3, record_id="good")))
    assert len(read_all(tmp_path)) == 2  # nothing counts before the commit
    writer.commit([good])
    assert Counter(r[0] for r in read_all(tmp_path)) == Counter({"good": 3, "urn:page:0": 1, "urn:page:1": 1})
    broken = warc.WarcWriter({"path": str(tmp_path)}, False)
    broken.abort([broken.write(iter(records(4))), None])
    assert len(read_all(tmp_path)) == 5 and all(p.is_file() for p in tmp_path.iterdir())


def test_writer_rolls_files_and_sweeps_what_broke(tmp_path):
    writer = warc.WarcWriter({"path": str(tmp_path), "filebytes": "10"}, True)

    rows = records(3)
    lost, good = writer.write(iter(rows)), writer.write(iter(rows))
    assert len(good.names) == 3
    (tmp_path / "old.warc").write_bytes(b"")
    writer.commit([good])
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(good.names) and lost.names


# ---------------------------------------------------------------- URLs

URLS = {
    "http://a.net/": ("a.net", "/", "net/", "block"),
    "http://NET/x": ("net", "/x", "net/", "block"),
    "http://a.net": ("a.net", "", None, "allow"),
    "https://m.Example.net/en/1?x=casino": ("m.example.net", "/en/1", "example.net/en/", "allow"),
    "https://badexample.net/en/1": ("badexample.net", "/en/1", "net/", "block"),
    "http://x.example.com/de/1": ("x.example.com", "/de/1", "example.com/de/", "block"),
    "http://x.example.com/DE/1": ("x.example.com", "/DE/1", None, "allow"),
    "http://x.org/fr/adult": ("x.org", "/fr/adult", "org/fr/", "allow"),
    "http://x.com/a?b=CASINO#c": ("x.com", "/a", None, "block"),
    "http://x.com/casinos": ("x.com", "/casinos", None, "allow"),
    "http://x.com/free-free": ("x.com", "/free-free", None, "allow"),
    "http://x.com/free_bets": ("x.com", "/free_bets", None, "block"),
    "http://x.com/pre-casino": ("x.com", "/pre-casino", None, "block"),
    "casino": ("", "", None, "block"),
    "a?u=http://y.com/p": ("y.com", "/p", None, "allow"),
    "http://h#f/x": ("h", "", None, "allow"),
    "http://h\n/x\ny": ("h\n", "/x\ny", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


@pytest.mark.parametrize("clashing", [False, True])
def test_urls_by_hand(spark, clashing):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, "http://a.net/"), (None, "http://l.com/" + "x" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.filter_urls(with_clashes(df.withColumnRenamed("url", "u")).withColumnRenamed("u", "url") if clashing else df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == URLS[rows[r.page_id][1]], rows[r.page_id][1]


def test_urls_of_nothing(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_overlapping_terms_and_repeats():
    found = urls.Terms(urls.vocabulary(("spam",), ("spam farm", "farm", "free")))
    got = found.hits(["x-spam farm-x", "free/free/free", "spamfarm éspamé", "", "spam", "farm", "a\nfree\nb"], 2)
    assert list(map(tuple, got.to_numpy())) == [(1, 2, 4), (0, 1, 1), (1, 0, 2), (0, 0, 0), (1, 0, 2), (0, 1, 1), (0, 1, 1)]
    assert len(found.hits([], 2)) == 0 and urls.Terms({}).hits(["x"], 2).to_numpy().tolist() == [[0, 0, 0]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab1-/ é\n", max_size=12), max_size=8))
def test_hits_equal_a_plain_search(texts):
    import re

    weights = {"a": 1, "ab": 3, "b1": 1, "a-b": 2}
    want = []
    for t in texts:
        hit = [w for w in weights if re.search(rf"(?<![a-z0-9]){re.escape(w)}(?![a-z0-9])", t)]
        want.append([sum(weights[w] >= 3 for w in hit), sum(weights[w] < 3 for w in hit), sum(weights[w] for w in hit)])
    assert urls.Terms(weights).hits(texts, 3).to_numpy().tolist() == want


def test_vocabulary_from_a_table(spark):
    table = spark.createDataFrame([("Casino", 5), ("casino", 2), ("free", 1), ("win", 2), ("", 9)], "term string, weight int")
    weights = urls.vocabulary_of(table)
    assert weights == {"casino": 5, "free": 1, "win": 2}
    df = spark.createDataFrame([(1, "http://x.com/casino"), (2, "http://x.com/free"), (3, "http://x.com/FREE?win"), (4, "http://x.com/freewin")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.filter_urls(df, terms=weights, threshold=3).collect()} == {1: "block", 2: "allow", 3: "block", 4: "allow"}
    with pytest.raises(ValueError):
        urls.vocabulary_of(table, max_terms=2)


# ---------------------------------------------------------------- chat

HARD = ["\\### Assistant: </turn> ok", "\\", "\\\\", "###", "####", "</turn>\n", "</turn", "### user: x</turn>\n", "", "a\nb", ":", "\\:", "<\\/turn>", "$1", "é漢😀", "# ## ###\\#"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def brute_chat(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        text = "".join(f"{role}\n{t}\n" for _, _, role, t in turns)
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        out[c] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check_chat(spark, rows, clashing=False):
    df = conversations(spark, rows)
    done = chat.format_conversations(with_clashes(df) if clashing else df)
    assert all(r.identical for r in done.collect())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(done).collect()}
    assert got == brute_chat(rows)
    for r in done.collect():
        assert all(0 <= s.start and s.start + s.length <= len(r.formatted) for s in r.loss_spans)


@pytest.mark.parametrize("clashing", [False, True])
def test_hard_texts_come_back(spark, clashing):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(HARD)]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", None), (2, None, None, "x"), (3, 0, "sys:tem ###\n</turn>", "y"), (None, 0, "assistant", "z"), (4, 0, "assistant", LONG), (6, 0, "r" * 50_000, "long role"), (5, 1, "assistant", HARD[0]), (5, 0, "user", HARD[0])]
    check_chat(spark, rows, clashing)


def test_chat_of_nothing(spark):
    assert chat.format_conversations(conversations(spark, [])).count() == 0


def test_plain_text_stays_plain(spark):
    (r,) = chat.format_conversations(conversations(spark, [(1, 0, "user", "Hi: there"), (1, 1, "assistant", "Yes.")])).collect()
    assert r.formatted == "### user: Hi: there</turn>\n### assistant: Yes.</turn>\n"
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == ["Yes."]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:#"]), st.text(alphabet="\\#</turn>\n: x\r", max_size=14)), min_size=1, max_size=30))
def test_any_text_comes_back(spark, turns):
    check_chat(spark, [(i % 3, i, role, text) for i, (role, text) in enumerate(turns)])


def test_long_conversations_take_time_in_proportion(spark):
    import time

    took = []
    for n in (500, 4000):
        rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} of ### many </turn> " + "x" * 400) for i in range(n)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        at = time.perf_counter()
        (row,) = chat.digests(chat.format_conversations(df)).collect()
        took.append(time.perf_counter() - at)
        loss = "".join(t for _, i, _, t in rows if i % 2)
        assert row.n_turns == n and row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert took[1] < 30


def test_a_conversation_that_does_not_come_back_is_an_error(spark):
    df = spark.createDataFrame([(1, "### user: a</turn>\n", False)], "conv_id long, formatted string, identical boolean")
    df = df.withColumn("loss_spans", F.array().cast("array<struct<start:int,length:int>>"))
    with pytest.raises(Exception, match="does not parse back"):
        chat.digests(df).collect()


def test_escaping_everything_gives_the_same_turns(spark):
    turns = [("user", "a ### b </turn> \\ c"), ("a: b", ""), ("", "\n"), ("assistant", "plain")]
    df = spark.createDataFrame([([(r, t) for r, t in turns],)], "turns array<struct<role:string,text:string>>")
    (row,) = df.select(chat.turns_only(chat.parse_turns(chat.render_escaped(F.col("turns")))).alias("back")).collect()
    assert [tuple(t) for t in row.back] == turns

import gzip
import hashlib
from collections import Counter

from tabguard.llm import chat, warc


def test_archives_round_trip(spark, tmp_path):
    same, small = "<p>" + "x" * 200, "y" * 50
    rows = [(5, "http://a/5", same), (2, "http://a/b c\r\nX: y", same), (None, None, same), (7, "http://ü/", None), (8, "u", ""), (3, "u", small), (4, "u", small), (9, "u", "é" * 300), (2, "u", same)]
    pages = spark.createDataFrame([(k, u, h, "z", 1) for k, u, h in rows], "page_id long, url string, html string, key string, first_key int").repartition(3)
    index = warc.archive_pages(pages, f"file://{tmp_path}/warc")
    found = warc.read_records(index).collect()
    expected = Counter()
    for key, _, html in rows:
        raw = (html or "").encode()
        later = html == same and key != 2
        expected[key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if later else "response", 2 if later else None, None if later else raw] += 1
    assert expected == Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found)
    files = [r.file for r in index.select("file").distinct().collect()]
    built = warc.index_archives(spark, files)
    parts = ["file", "offset", "length", "payload_digest", "payload_bytes", "record_type", "key", "refers_to"]
    assert Counter(map(tuple, built.select(*parts).collect())) == Counter(map(tuple, index.select(*parts).collect()))
    chosen = warc.read_records(index.where("key = 9")).collect()
    assert [r.payload.decode() for r in chosen] == ["é" * 300]
    empty = warc.archive_pages(pages.limit(0), f"file://{tmp_path}/none")
    assert empty.count() == 0 and warc.read_records(empty).count() == 0


def test_uncompressed_archives_are_indexed(spark, tmp_path):
    records = [warc.encode_record(i, "u", b"p" * i, hashlib.sha256(b"p" * i).hexdigest(), "response", None, i) for i in (0, 3, 5000)]
    plain = [gzip.decompress(r) for r in records]
    (tmp_path / "a.warc").write_bytes(b"".join(plain))
    rows = warc.index_archives(spark, [f"file://{tmp_path}/a.warc"]).orderBy("offset").collect()
    assert [(r.length, r.payload_bytes) for r in rows] == [(len(p), n) for p, n in zip(plain, (0, 3, 5000))]


def test_ranges_are_coalesced():
    spans = [(0, 10), (10, 5), (40, 5), (1000, 10)]
    assert warc.coalesced(spans, max_gap=30, max_read=100) == [(0, 45, 0, 3), (1000, 1010, 3, 4)]
    assert warc.coalesced(spans, max_gap=30, max_read=20) == [(0, 15, 0, 2), (40, 45, 2, 3), (1000, 1010, 3, 4)]
    assert warc.coalesced([]) == []


def plain_chats(rows):
    steps = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            steps.setdefault(conv, {}).setdefault(-1 if turn is None else turn, []).append((role, text))
    form = {c: [(t, sorted(s[t], key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or ""))) for t in sorted(s)] for c, s in steps.items()}
    kept = []
    for c, own in form.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in form.values())
        twin = any(o == own and d < c for d, o in form.items())
        if not longer and not twin:
            kept.append(c)
    out = Counter()
    for c in kept:
        parts = {}
        for turn, step in form[c]:
            for role, text in step:
                name = "unknown" if role is None else role.strip(" ").lower()
                parts.setdefault(turn // 512, []).append(f"<|{name}|>\n{(text or '').replace('<|', '< |')}<|end|>\n")
        for part, texts in parts.items():
            out[c, part, len(texts), "".join(texts)] += 1
    return out


def test_chats_equal_brute_force(spark):
    base = [("User", "hi"), ("assistant", "yes <|x|>"), ("user", None), (None, ""), ("assistant", "end")]
    rows = [(c, t, *base[t]) for c in range(6) for t in range(c)]  # conversation 5 holds all others
    rows += [(10, t, *base[t]) for t in range(5)] + [(11, t, *base[t]) for t in range(4)] + [(11, 4, "assistant", "other")]
    rows += [(12, None, "user", "x"), (12, 0, "user", "hi"), (13, 0, "user", "hi"), (13, 0, "user", "hi"), (14, 2, "user", "gap"), (None, 0, "user", "lost")]
    rows += [(15, t, "user", f"turn {t}") for t in range(1500)] + [(16, t, "user", f"turn {t}") for t in range(1100)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, block string").repartition(5)
    found = Counter((r.conv_id, r.part, r.n_turns, r.chat) for r in chat.format_chats(frame).collect())
    assert found == plain_chats(rows)
    assert chat.format_chats(frame.limit(0)).count() == 0

import hashlib
import math

import numpy as np
import pytest

from tabguard.llm.balls import Balls, Codec, code_digests, compress, nearest_of_all


def plain(rows, parts=16, entries=64, rounds=2):
    """rows: (id, integer vector) in id order -> codes, errors, codebooks, by comparing with every entry."""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in rows]
    books = [[cut[r][p] for r in range(min(entries, len(rows)))] for p in range(parts)]

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(c[p], books[p][e])), e)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[i][p] for i in range(len(rows)) if codes[i][p] == e]
                if own:
                    books[p][e] = [sum(x[k] for x in own) // len(own) for k in range(width)]
    codes = assign()
    errors = [sum(sum((a - b) ** 2 for a, b in zip(cut[i][p], books[p][codes[i][p]])) for p in range(parts)) for i in range(len(rows))]
    return codes, errors, books


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, codes string, v int")


@pytest.mark.parametrize("spread", [0.02, 0.4])
def test_codes_equal_brute_force(spark, spread):
    r = np.random.default_rng(5)
    centres = r.normal(0, 0.5, (9, 32))
    vectors = (centres[r.integers(0, 9, 150)] + r.normal(0, spread, (150, 32))).astype(np.float32)
    vectors[20:24] = vectors[3]  # equal vectors
    rows = [(int(i) * 3 - 40, v.tolist(), int(i) % 4 or None, "x", 1) for i, v in enumerate(vectors)]
    odd = [(-900, None, 1, "x", 1), (-901, [float("nan")] * 32, 1, "x", 1), (-902, [None] + [0.5] * 31, 1, "x", 1), (-903, [float("inf")] * 32, None, "x", 1), (-904, [1.0], 1, "x", 1)]
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, *_ in rows]
    codes, errors, books = plain(whole)
    found = {x.vec_id: x for x in code_digests(frame(spark, rows + odd)).collect()}
    assert sorted(found) == [i for i, _ in whole]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    by_label = {}
    for (i, _, label, *_), e in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + e
    for (i, _, label, *_), c, e in zip(rows, codes, errors):
        assert (found[i].code, found[i].error, found[i].label_error) == ("".join(f"{x:02x}" for x in c), e, by_label[label])
        assert found[i].codebooks_sha256 == digest


def test_balls_leave_out_only_what_cannot_win():
    r = np.random.default_rng(6)
    points = r.integers(-60, 60, (4000, 3))
    points[:500] = points[500:1000]
    entries = r.integers(-60, 60, (40, 3))
    entries[7] = entries[3]  # equal entries: ties go to the lower one
    codes, gaps = nearest_of_all(points, entries)
    moved = entries + r.integers(-4, 5, entries.shape)
    moved[7] = moved[3]
    own = ((points - moved[codes]) ** 2).sum(axis=1)
    reach = np.array([own[codes == e].max(initial=-1) for e in range(40)])
    found, best, compared = Balls(moved, reach).assign(points, codes)
    want, least = nearest_of_all(points, moved)
    assert (found == want).all() and (best == least).all()
    assert compared < 0.5 * len(points) * len(entries)


def test_small_odd_and_empty_inputs(spark):
    empty = frame(spark, [])
    assert code_digests(empty).collect() == [] and compress(empty)[1].size == 0
    one = code_digests(frame(spark, [(None, [0.5, -0.001, 0.25], None, "", 0)] * 2)).collect()  # repeated rows, null ids
    assert [(x.vec_id, x.code, x.error, x.label_error) for x in one] == [(None, "00" * 16, 0, 0)] * 2
    entries = [x for x in (128, -1, 64, *[0] * 13) for _ in range(2)]
    assert one[0].codebooks_sha256 == hashlib.sha256(",".join(map(str, entries)).encode()).hexdigest()
    books = compress(frame(spark, [(1, [0.5, -0.001, 0.25], 1, "", 0), (0, [1.0, 0.0, 0.0], 1, "", 0)]))[1]
    assert books.shape == (16, 2, 1) and books[:3, :, 0].tolist() == [[256, 128], [0, -1], [0, 64]]
    huge = compress(frame(spark, [(1, [1e30] * 16, 1, "", 0), (2, [2.0] * 16, 1, "", 0)]))[0].collect()
    assert [x.vec_id for x in huge] == [2]
    small = compress(frame(spark, [(i, [i / 10.0, 1.0], 1, "", 0) for i in range(300)]), codec=Codec(parts=2, entries=300, rounds=1))[0]
    assert {tuple(x.codes) for x in small.collect()} >= {(299, 0), (256, 0)}  # entries beyond one byte

"""The Merkle manifest against a plain reading of its definition."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tickerlake.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climbed(nodes):
    """The root of a list of nodes, and the siblings (left, right) of each node on its way there."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(paths):
            run, place = divmod(at[k], 3)
            run = nodes[3 * run:3 * run + 3]
            p.append(("".join(run[:place]), "".join(run[place + 1:])))
            at[k] //= 3
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    def utf8(s):
        return b"" if s is None else b"\x01" + s.encode()

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r)))
    names = sorted(groups, key=utf8)
    subs, ways = [], []
    for name in names:
        groups[name].sort()
        sub, paths = climbed([x[2] for x in groups[name]])
        subs.append(sub)
        ways.append(paths)
    root, tops = climbed(subs)
    return sorted((str(x[1]) if x[0] else "", x[2], sub, root, tuple(p + top))
                  for name, sub, paths, top in zip(names, subs, ways, tops, strict=True) for x, p in zip(groups[name], paths, strict=True))


def odd_rows():
    rows = [(i, "hot", "en", i, f"text {i}\nnext") for i in range(-40, 60)]
    rows += [(i, f"s{i % 5}", None, None, "é" * (i % 4)) for i in range(23)]
    rows += [(None, "hot", "en", 1, "a"), (None, None, None, None, None), (7, None, "de", 3, ""), (7, None, "de", 3, ""), (7, None, "de", 3, "x\n"),
             (8, "", "en", 0, "漢字\n" * 30_000), (9, "ÿ", "en", 0, "-"), (9, "\U0001f600", "en", 0, None), (9, "￮", "en", 0, "1:a")]
    return rows


def run(rows, **kw):
    leaves = rows.select("doc_id", "source", merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("leaf"))
    got = merkle.manifest(leaves, "source", "doc_id", **kw).collect()
    return sorted(("" if r.doc_id is None else str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in got)


@pytest.mark.parametrize("levels", [2, merkle.LEVELS])
def test_manifest_equals_plain_reading(spark, levels):
    rows = odd_rows()
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(5), levels=levels) == plain_manifest(rows)


def test_small_and_empty_tables(spark):
    for rows in ([(1, "a", "en", 1, "x")], [(i, None, "en", 1, "x") for i in range(4)], [(1, f"s{i:02}", "en", 1, "x") for i in range(10)]):
        assert run(spark.createDataFrame(rows, SCHEMA), levels=1) == plain_manifest(rows)
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_query_on_odd_rows(spark, scratch):
    """Clashing extra columns, tampered and untampered rows; a tampered text without a line break stays verified."""
    import zlib

    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("leaf", "node", "path", "pos", "size", "block", "root", "items", "levels", "tampered_leaf"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = queries.op12_merkle(spark, scratch).collect()
    plain = plain_manifest(rows)
    assert sorted(("" if r.doc_id is None else str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == [
        (*x[:4], h(*[a + b for a, b in x[4]])) for x in plain]
    shown = {plain_leaf(*r): r for r in rows}
    for r in got:
        doc_id, *_, text = shown[r.leaf]
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and "\n" in (text or "")
        assert r.verified == (not changed) == (r.folded_root == r.root)
    # a shorter text has another digest, and folding it gives what the plain reading gives
    tampered = {r.leaf: r.folded_root for r in got if not r.verified}
    for x in plain:
        if x[1] in tampered:
            row = shown[x[1]]
            node = plain_leaf(*row[:4], row[4].replace("\n", ""))
            for left, right in x[4]:
                node = h(left, node, right)
            assert node == tampered[x[1]]
    assert len(tampered) > 20

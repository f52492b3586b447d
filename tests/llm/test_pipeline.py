"""The pipeline and the registered queries against brute force on small tables."""

import hashlib
from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from farpoint.llm import bpe, mixing, quality_rules
from farpoint.llm.queries import ORACLE_SQL, QUERIES

from test_operators import WORD, brute_fingerprint, brute_lines, library_ids

SF = "/root/testdata/sf0.001"


def test_pipeline_by_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    rows = [r for r in rows if not any(
        rule.rejects(quality_rules.Signals(r[1] or "")) for rule in quality_rules.RULES)]
    left = brute_lines(rows)
    rows = [(d, left[d][1], s) for d, _, s in rows]
    bits = {d: brute_fingerprint(t) for d, t, _ in rows}
    part = {d: d for d in bits}
    for a in bits:
        for b in bits:
            if a < b and (bits[a] ^ bits[b]).bit_count() <= 4 and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = {k: low if v == high else v for k, v in part.items()}
    rows = [r for r in rows if part[r[0]] == r[0]]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    sources = sorted(sizes)
    goal = dict(zip(sources, mixing.targets([sizes[s] for s in sources]), strict=True))
    mixed = []
    for s in sources:
        at, words = 0, int(goal[s] + 0.5)
        mine = sorted((hashlib.md5(f"{d}:7".encode()).hexdigest(), d, t)
                      for d, t, o in rows if o == s)
        for _, d, t in mine:
            n = len(WORD.findall(t))
            if n:
                part_words = max(0, min(n, words % sizes[s] - at))
                mixed += [(d, t)] * (words // sizes[s] + (part_words == n))
                if 0 < part_words < n:
                    mixed.append((d, " ".join(WORD.findall(t)[:part_words])))
            at += n
    want = Counter((d, len(ids), bpe.sha256(" ".join(map(str, ids))), bpe.sha256(decoded))
                   for (d, _), (ids, decoded) in
                   zip(mixed, library_ids([t for _, t in mixed]), strict=True))
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())

"""DuckDB SQL of the operators that SQL can say."""

from __future__ import annotations


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Product codes: the rounds one after the other, in integers; floors of negative sums go down."""
    near = """near{k} AS MATERIALIZED (SELECT l.r, l.part, min(struct_pack(d := l.d, e := l.entry)) AS best FROM (
 SELECT v.r, v.part, b.entry, CAST(sum((v.x - b.x) * (v.x - b.x)) AS BIGINT) AS d
 FROM long v JOIN book{k} b USING (part, position) GROUP BY v.r, v.part, b.entry) l GROUP BY l.r, l.part)"""
    book = """book{n} AS MATERIALIZED (SELECT b.part, b.entry, b.position, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
 SELECT part, entry, position, (s - ((s % n) + n) % n) // n AS x FROM (
  SELECT v.part, a.best.e AS entry, v.position, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n
  FROM long v JOIN near{k} a USING (r, part) GROUP BY 1, 2, 3)) m USING (part, entry, position))"""
    steps = [s for k in range(rounds) for s in (near.format(k=k), book.format(k=k, n=k + 1))] + [near.format(k=rounds)]
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS MATERIALIZED (SELECT r, vec_id, (i - 1) // w AS part, (i - 1) % w AS position,
  CAST(floor(4096 * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x
 FROM (SELECT *, len(v) // {parts} AS w, unnest(range(1, len(v) + 1)) AS i FROM kept)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT DISTINCT vec_id FROM kept) ORDER BY vec_id LIMIT {entries}),
book0 AS MATERIALIZED (SELECT part, entry, position, min(x) AS x FROM long JOIN first USING (vec_id) GROUP BY 1, 2, 3),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
 FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
 (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, position)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""


#: Terms are the runs of digits, letters and all beyond ASCII, A-Z lower-cased; all but the weight is in 64-bit integers.
_RANKED = r"""WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
found AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM found GROUP BY 1),
whole AS (SELECT count(*) AS N_, CAST(sum(n) AS BIGINT) AS L_ FROM lengths),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * N_ + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
 FROM (SELECT term, count(*) AS df FROM found WHERE term IN (SELECT term FROM asked) GROUP BY 1), whole),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_) // L_)))) AS BIGINT) AS score
 FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), whole GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name; it takes ids to be unique, as they are in the given tables."""
    return {"op11_codes": _codes(), "op13_ranked": _RANKED}

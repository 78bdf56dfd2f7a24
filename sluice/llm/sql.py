"""DuckDB SQL for the rows of those queries that SQL can express, written plainly: every pair is compared where the operator has an index."""

from __future__ import annotations

from . import line_dedup as ld
from . import url_filter as uf
from .chat_rotation import SQL as CHAT

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY 1),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 75 * (p.size + q.size - shared)),
sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS root, a AS node FROM sym UNION SELECT root, sym.b FROM reach JOIN sym ON sym.a = reach.node),
c AS (SELECT node, min(root) AS component FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.size, 0) AS n_shingles, coalesce(c.component, w.doc_id) AS component_id, coalesce(c.component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""

LINES = f"""
WITH RECURSIVE split_up AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
each AS (SELECT doc_id, unnest(range(len(l))) AS k, l FROM split_up),
lines AS (SELECT doc_id, CAST(k AS INTEGER) AS line_no, line FROM (SELECT doc_id, k, trim(l[k + 1], ' ' || chr(9) || chr(13)) AS line FROM each) WHERE length(line) >= {ld.MIN_CHARS}),
t AS (SELECT line, length(line) AS n, min(doc_id * 10000000 + line_no) AS place FROM lines GROUP BY line),
long AS (SELECT * FROM t WHERE n >= {ld.FUZZY_CHARS}),
-- two lines within the threshold differ in one half only; n is the shorter one's length
ends AS (SELECT line, unnest(range(n - {ld.THRESHOLD}, n + 1)) AS n FROM long),
near AS (
  SELECT a.line AS a, b.line AS b FROM ends a JOIN ends b ON a.n = b.n AND left(a.line, a.n // 2) = left(b.line, b.n // 2) AND a.line <> b.line
  UNION SELECT a.line, b.line FROM ends a JOIN ends b ON a.n = b.n AND right(a.line, a.n // 2) = right(b.line, b.n // 2) AND a.line <> b.line),
links AS (SELECT a, b FROM near WHERE abs(length(a) - length(b)) <= {ld.THRESHOLD} AND levenshtein(a, b) <= {ld.THRESHOLD}),
reach AS (SELECT a AS root, a AS node FROM links UNION SELECT root, links.b FROM reach JOIN links ON links.a = reach.node),
first AS (SELECT line, least(t.place, coalesce(p, t.place)) AS place FROM t LEFT JOIN (SELECT node, min(t.place) AS p FROM reach JOIN t ON t.line = reach.root GROUP BY 1) ON node = line),
degree AS (SELECT a AS line, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, line_no, place // 10000000 AS class_doc_id, CAST(place % 10000000 AS INTEGER) AS class_line_no, coalesce(n_links, 0) AS n_links, place = doc_id * 10000000 + line_no AS kept
FROM lines JOIN first USING (line) LEFT JOIN degree USING (line)
"""


def _rules() -> tuple[str, str]:
    ordered = sorted(uf.RULES, key=lambda r: (-len(r[1] + r[2]), r))
    when = lambda k: "CASE " + " ".join(f"WHEN ends_with('.' || host, '.{h}') AND starts_with(path, '{p}') THEN '{(h + p, v)[k]}'" for v, h, p in ordered) + " END"
    return when(0), when(1)


_S = [f"coalesce(regexp_replace(seg[{k + 1}], '[0-9]+', '#', 'g'), '')" for k in range(uf.DEPTH)]


def _wild() -> str:
    """The tree's levels: one pair of CTEs for each."""
    out = []
    for k in range(uf.DEPTH):
        parent = ", ".join(["host", *(f"t{j}" for j in range(k))])
        out.append(f"c{k} AS (SELECT {parent}, s{k}, sum(n) AS pages FROM g{k} GROUP BY ALL)")
        out.append(f"f{k} AS (SELECT {parent}, count(*) AS children, sum(pages) AS total FROM c{k} GROUP BY ALL)")
        out.append(f"g{k + 1} AS (SELECT g.*, CASE WHEN children > {uf.MAX_CHILDREN} AND 100 * pages < {uf.MIN_SHARE_PERCENT} * total THEN '*' ELSE g.s{k} END AS t{k} FROM g{k} g JOIN c{k} USING ({parent}, s{k}) JOIN f{k} USING ({parent}))")
    return ",\n".join(out)


_BELOW = "concat_ws('/', " + ", ".join(f"t{k}" for k in range(1, uf.DEPTH)) + ")"
_KEY = ", ".join(["host", *(f"s{k}" for k in range(uf.DEPTH))])

URLS = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, {_rules()[0]} AS rule, {_rules()[1]} AS ruled, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg FROM h),
base AS (SELECT page_id, host, path, rule, ruled, {", ".join(f"{s} AS s{k}" for k, s in enumerate(_S))} FROM r),
g0 AS (SELECT {_KEY}, count(*) AS n, count(*) FILTER (ruled = 'block') AS blocked, count(ruled) AS labelled FROM base GROUP BY ALL),
{_wild()},
sub AS (SELECT host, t0, {_BELOW} AS below, sum(n) AS n, sum(blocked) AS blocked, sum(labelled) AS labelled FROM g{uf.DEPTH} GROUP BY ALL),
br AS (SELECT host, t0, sum(n) AS total, sum(blocked) AS b, sum(labelled) AS l FROM sub GROUP BY ALL),
sp AS (SELECT host, t0, string_agg(part, '|' ORDER BY part) AS spread FROM (
  SELECT host, t0, below || ':' || CAST((20 * n + total) // (2 * total) AS VARCHAR) AS part, (20 * n + total) // (2 * total) AS tenths FROM sub JOIN br USING (host, t0)) WHERE tenths > 0 GROUP BY ALL),
pooled AS (SELECT host, t0, spread, b, l, (sum(b) OVER w + 0.5) / (sum(l) OVER w + 1) AS p FROM br LEFT JOIN sp USING (host, t0) WINDOW w AS (PARTITION BY host, spread)),
m AS (SELECT host, t0, coalesce(spread, '') AS spread, CASE WHEN l > 0 AND abs(b - p * l) > 2 * sqrt(l * p * (1 - p)) + 1 THEN t0 ELSE chr(1) END AS merged FROM pooled),
bad AS (SELECT host, spread, merged, below FROM sub JOIN m USING (host, t0) GROUP BY ALL
  HAVING 100 * sum(labelled) >= {uf.LABELLED_PERCENT} * sum(n) AND 100 * (2 * sum(blocked) + {uf.SMOOTHING}) >= {uf.PURITY_PERCENT} * 2 * (sum(labelled) + {uf.SMOOTHING})),
hit AS (SELECT DISTINCT host, t0, below FROM sub JOIN m USING (host, t0) JOIN bad USING (host, spread, merged, below)),
rej AS (SELECT {_KEY}, TRUE AS rejected FROM (SELECT *, {_BELOW} AS below FROM g{uf.DEPTH}) JOIN hit USING (host, t0, below))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict FROM base LEFT JOIN rej USING ({_KEY})
"""

ORACLE = {"op1_line_dedup": LINES, "op4_minhash_dedup": NEAR_DUPLICATES, "op8_chat_rotation": CHAT, "op10_url_filter": URLS}

"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: eight shifts a byte, least bit first."""
    shift = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    byte = f"list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: {shift})"
    data = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda crc, b: {byte}), 4294967295)"


def _leaf(text: str) -> str:
    parts = [
        f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(parts)})"


def _climb(name: str, levels: int) -> list[str]:
    """CTEs ``{name}1`` on: the nodes of each level, unchanged (``lone``) where one is left."""
    return [
        f"{name}{k} AS (SELECT g, i // 16 AS i, CAST(ceil(m / 16) AS BIGINT) AS m, m = 1 AS lone, list(h ORDER BY i) AS run, "
        f"CASE WHEN m = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h "
        f"FROM {name}{k - 1} GROUP BY g, i // 16, m)"
        for k in range(1, levels + 1)
    ]


def _ways(name: str, group: str, index: str, levels: int) -> tuple[str, list[tuple[str, str, str]]]:
    """Joins from a row to its runs, and per level (left siblings, right siblings, lone)."""
    joins, steps = "", []
    for k in range(1, levels + 1):
        at, seat = f"{name}_{k}", f"(({index} // {16 ** (k - 1)}) % 16)"
        joins += f" JOIN {name}{k} {at} ON {at}.g = {group} AND {at}.i = {index} // {16**k}"
        steps.append((f"array_to_string({at}.run[1:{seat}], '')", f"array_to_string({at}.run[{seat} + 2:], '')", f"{at}.lone"))
    return joins, steps


def merkle(levels: int = 6, top_levels: int = 4) -> str:
    """The manifest for up to 16^6 rows a source and 16^4 sources."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    key = "CASE WHEN source IS NULL THEN '' ELSE '=' || source END"
    tampered = f"doc_id IS NOT NULL AND {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0"
    joins, steps = _ways("tree", "b.g", "b.i", levels)
    top_joins, top_steps = _ways("top", "''", "t.i", top_levels)
    steps += top_steps
    sides = ", ".join(f"{a} AS l{k}, {b} AS r{k}, {c} AS lone{k}" for k, (a, b, c) in enumerate(steps))
    proof = " || ".join(f"l{k} || r{k}" for k in range(len(steps)))
    ctes = [
        f"leaves AS (SELECT doc_id, {key} AS g, {_leaf('text')} AS leaf, "
        f"CASE WHEN {tampered} THEN {_leaf(lower)} ELSE {_leaf('text')} END AS f0 FROM documents)",
        "base AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)",
        "tree0 AS (SELECT g, i, count(*) OVER (PARTITION BY g) AS m, leaf AS h FROM base)",
        *_climb("tree", levels),
        f"top0 AS (SELECT '' AS g, g AS name, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS m, h FROM tree{levels})",
        *_climb("top", top_levels),
        f"proved AS (SELECT doc_id, leaf, t.h AS subroot, top_{top_levels}.h AS root, f0, {sides} "
        f"FROM base b JOIN top0 t ON t.name = b.g{joins}{top_joins})",
    ]
    for k in range(len(steps)):
        last = f"fold{k}" if k else "proved"
        ctes.append(f"fold{k + 1} AS (SELECT *, CASE WHEN lone{k} THEN f{k} ELSE sha256(l{k} || f{k} || r{k}) END AS f{k + 1} FROM {last})")
    end = len(steps)
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, "
        f"f{end} AS folded_root, f{end} = root AS verified FROM fold{end}"
    )


def minhash() -> str:
    """Components of documents by the similarity of their four-word shingle sets."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    return f"""WITH RECURSIVE worded AS (SELECT doc_id, {words} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] ELSE
  list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s FROM worded),
keyed AS (SELECT doc_id, len(s) AS n, md5(array_to_string(s, chr(10))) AS k, s FROM sets),
one AS (SELECT k, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS least FROM keyed WHERE n > 0 GROUP BY k),
parts AS (SELECT k, n, unnest(s) AS p FROM one),
pairs AS (SELECT a.k AS u, b.k AS v FROM parts a JOIN parts b ON a.p = b.p AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT k AS u, k AS v FROM one UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u),
ids AS (SELECT r.u AS k, min(o.least) AS c FROM reach r JOIN one o ON o.k = r.v GROUP BY r.u)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id, doc_id = coalesce(c, doc_id) AS kept
FROM keyed LEFT JOIN ids ON ids.k = keyed.k AND n > 0"""

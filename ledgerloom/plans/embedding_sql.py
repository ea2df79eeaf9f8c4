"""The default embedder as SQL, so that queries on its vectors can be compared."""

from __future__ import annotations

_WORDS = "regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}_]+')"


def embed_sql(name: str, source: str, key: str, text: str, dims: int) -> str:
    """CTEs ending in ``name`` (key, v): counts of hashed lower-case words of each text, scaled to length 1."""
    return f"""{name}_w AS (SELECT {key} AS k, unnest({_WORDS.format(text=text)}) AS w FROM {source}),
        {name}_n AS (SELECT k, CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % {dims} AS INTEGER) AS d, count(*)::DOUBLE AS n
                     FROM {name}_w WHERE w <> '' GROUP BY ALL),
        {name}_l AS (SELECT k, sqrt(sum(n * n)) AS length FROM {name}_n GROUP BY k),
        {name}_d AS (SELECT {key} AS k, unnest(range({dims})) AS d FROM {source}),
        {name} AS (SELECT g.k AS {key}, list(coalesce(n.n / l.length, 0.0) ORDER BY g.d) AS v
                   FROM {name}_d g LEFT JOIN {name}_n n ON g.k = n.k AND g.d = n.d LEFT JOIN {name}_l l ON g.k = l.k GROUP BY g.k)"""

"""SQL for DuckDB that the registered queries must agree with, where SQL can say it."""

from __future__ import annotations

from strata.llm import licenses, mixing, quality_rules, queries, sharding

_WORD = r"[^\x20\x09-\x0D]+"


def _quality_rules() -> str:
    stop = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)
    bounds = " AND ".join(
        " AND ".join(
            f"{rule.numerator} {sign} {bound} * {rule.denominator}"
            for sign, bound in ((">=", rule.least), ("<=", rule.most))
            if bound is not None
        )
        for rule in quality_rules.CORPUS_RULES
    )
    languages = ", ".join(f"'{name}'" for name in ("", "und", *quality_rules.LANGUAGES))
    return rf"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
           lower(coalesce(regexp_extract(lang, '^\s*(\p{{L}}*)', 1), '')) IN ({languages}) AS named
    FROM documents
), parts AS (
    SELECT rid, doc_id, t, named, regexp_extract_all(t, '{_WORD}') AS w,
           length(regexp_replace(t, '[\P{{L}}{quality_rules.LETTERS}]+', '', 'g')) AS other_letters,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
    FROM texts
), windows AS (
    SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS win
    FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM parts WHERE len(w) >= 8)
), again AS (
    SELECT rid, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), covered AS (
    SELECT rid, count(DISTINCT place) AS n
    FROM (SELECT rid, unnest(range(i, i + 8)) AS place FROM again) GROUP BY rid
), counts AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           length(array_to_string(list_filter(w, lambda x: length(x) > {quality_rules.LONG_WORD}), ''))
               AS long_word_chars,
           length(array_to_string(list_filter(w, lambda x: length(x) <= {quality_rules.LONG_WORD}), ''))
               AS ordinary_chars,
           len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words_any_case,
           CASE WHEN named AND 100 * other_letters <= {quality_rules.FOREIGN_PERCENT}
               * length(array_to_string(w, '')) THEN len(w) ELSE 0 END AS n_words_of_known_language,
           coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM parts LEFT JOIN covered USING (rid)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {bounds} AS kept
FROM judged
"""


def _mixing() -> str:
    weight = " ".join(
        f"WHEN n % {len(mixing.WEIGHTS)} = {k} THEN {value}.0" for k, value in enumerate(mixing.WEIGHTS)
    )
    most = f"{mixing.MOST_COPIES}.0"
    return rf"""
WITH sized AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size
    FROM documents
), numbered AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
    FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, (CASE {weight} END)::DOUBLE AS weight,
           (source_size * {most})::DOUBLE AS cap
    FROM numbered
), levels AS (
    SELECT *, (sum(source_size::DOUBLE) OVER () * {mixing.SHARE}::DOUBLE
               - coalesce(sum(cap) OVER before, 0)) /
              (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM weighed
    WINDOW before AS (ORDER BY cap / weight, source NULLS FIRST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), sources AS (
    SELECT source, source_size,
           CASE WHEN cap <= weight * level THEN cap ELSE weight * common END AS target
    FROM levels, (SELECT min_by(level, cap / weight) AS common FROM levels WHERE cap > weight * level)
), classes AS (
    SELECT source, length(bin(size)) AS merit, sum(size)::DOUBLE AS words
    FROM sized GROUP BY source, merit
), rates AS (
    SELECT c.*, target, source_size,
           (target - coalesce(sum(words) OVER before, 0) * {most}) /
           nullif(sum(words * merit) OVER (PARTITION BY c.source)
                  - coalesce(sum(words * merit) OVER before, 0), 0) AS level
    FROM classes c JOIN sources s ON c.source IS NOT DISTINCT FROM s.source
    WINDOW before AS (PARTITION BY c.source ORDER BY merit DESC
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), expected AS (
    SELECT *, CASE WHEN coalesce(merit * level >= {most}, FALSE) THEN {most}::DOUBLE
              ELSE greatest(least(coalesce(merit * max_by(level, merit)
                   FILTER (WHERE NOT coalesce(merit * level >= {most}, FALSE))
                   OVER (PARTITION BY source), 0), {most}::DOUBLE), 0::DOUBLE) END AS e
    FROM rates
), lefts AS (
    SELECT *, floor(e) AS certain, e - floor(e) AS pi,
           target - sum(floor(e) * words) OVER (PARTITION BY source) AS rest
    FROM expected
), drawn AS (
    SELECT d.doc_id, d.source, d.size, source_size, target, certain, rest, pi,
           (('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT
            ::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM sized d JOIN lefts l
    ON d.source IS NOT DISTINCT FROM l.source AND length(bin(d.size)) = l.merit
), ranked AS (
    SELECT *, CASE WHEN pi > 0 AND size > 0 THEN (u / (1 - u)) / (pi / (1 - pi)) END AS q FROM drawn
), units AS (
    SELECT source, q, doc_id, size, rest, sum(size)::DOUBLE AS words FROM ranked
    WHERE q IS NOT NULL GROUP BY ALL
), summed AS (
    SELECT *, sum(words) OVER (PARTITION BY source ORDER BY q, doc_id, size
                               ROWS UNBOUNDED PRECEDING) AS upto FROM units
), gaps AS (
    SELECT source, any_value(rest) - coalesce(max(upto) FILTER (WHERE upto <= rest), 0) AS gap
    FROM summed GROUP BY source
), fillers AS (
    SELECT s.source, min(row(abs(words - gap), doc_id, size)) AS filler
    FROM summed s JOIN gaps g ON s.source IS NOT DISTINCT FROM g.source
    WHERE upto > rest AND words < 2 * gap GROUP BY s.source
)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.certain + (r.q IS NOT NULL AND (coalesce(s.upto <= s.rest, FALSE)
        OR coalesce(f.filler[2] = r.doc_id AND f.filler[3] = r.size, FALSE)))::INT))::BIGINT AS taken
FROM ranked r
LEFT JOIN summed s ON r.source IS NOT DISTINCT FROM s.source AND r.doc_id = s.doc_id AND r.size = s.size
LEFT JOIN fillers f ON r.source IS NOT DISTINCT FROM f.source
"""


def _sharding() -> str:
    """The table filled claim by claim, then looked up."""
    shards = queries.SHARDS
    size = sharding.prime_from(sharding.SLOTS_PER_SHARD * len(shards))
    names = ", ".join(f"'{name}'" for name in shards)
    first = "('0x' || substr(md5({}), 1, 13))::BIGINT"
    return rf"""
WITH RECURSIVE prefs AS MATERIALIZED (
    SELECT list({first.format("'offset:' || s")} % {size} ORDER BY n) AS offsets,
           list({first.format("'skip:' || s")} % {size - 1} + 1 ORDER BY n) AS skips
    FROM (SELECT unnest([{names}]) AS s, unnest(range({len(shards)})) AS n)
), claims AS (
    SELECT 0 AS claim, -1::BIGINT AS slot, [FALSE for i in range({size})] AS taken
    UNION ALL
    SELECT claim + 1, slot, list_transform(taken, lambda t, i: t OR i = slot + 1)
    FROM (SELECT claim, taken, list_extract(list_filter(
              [(offsets[claim % {len(shards)} + 1] + j * skips[claim % {len(shards)} + 1]) % {size}
               for j in range({size})], lambda s: NOT taken[s + 1]), 1) AS slot
          FROM claims, prefs WHERE claim < {size})
), owners AS (
    SELECT slot, ([{names}])[(claim - 1) % {len(shards)} + 1] AS shard FROM claims WHERE claim > 0
), keyed AS (
    SELECT doc_id, source, text, ({first.format("concat_ws(chr(31), coalesce('=' || source, '-'), coalesce('=' || doc_id, '-'))")} % {size})::INT
           AS shard_slot
    FROM documents
)
SELECT doc_id, source, shard_slot, shard, count(*) OVER (PARTITION BY shard) AS shard_rows,
       sum(length(text)) OVER (PARTITION BY shard)::BIGINT AS shard_chars
FROM keyed JOIN owners ON shard_slot = slot
"""


def _licenses() -> str:
    def canonical(text: str) -> str:
        made = f"lower(coalesce({text}, ''))"
        first = ((licenses.COPYRIGHT_LINE, "$1"), (licenses.LIST_MARK, "$1"))
        steps = (*first, *licenses.SPELLINGS, (licenses.PUNCTUATION, " "))
        for pattern, spelling in steps:
            to = spelling.replace("$", "\\")
            made = f"regexp_replace({made}, '{pattern}', '{to}', 'g')"
        return made

    def whole(canon: str) -> str:
        return rf"trim(regexp_replace({canon}, '[ \n]+', ' ', 'g'))"

    quoted = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''"))
        for name, text in licenses.listed_texts()
    )
    return rf"""
WITH known AS (
    SELECT md5({whole(canonical("t"))}) AS digest, min(name) AS license
    FROM (VALUES {quoted}) v(name, t) GROUP BY 1
), made AS (
    SELECT row_number() OVER () AS rid, doc_id, {canonical("text")} AS canon FROM documents
), lines AS (
    SELECT rid, n, md5(trim(line)) AS digest
    FROM (SELECT rid, unnest(string_split(canon, chr(10))) AS line,
                 generate_subscripts(string_split(canon, chr(10)), 1) AS n FROM made)
), notices AS (
    SELECT rid, string_agg(license, ',' ORDER BY n) AS notices
    FROM lines JOIN known USING (digest) GROUP BY rid
), texts AS (
    SELECT rid, doc_id, md5({whole("canon")}) AS digest FROM made
)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices
FROM texts LEFT JOIN known USING (digest) LEFT JOIN notices USING (rid)
"""


_KDTREE = """
WITH numbers AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM numbers q, numbers c
    WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 10
"""


_HARD_NEGATIVES = """
WITH numbers AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_inner_product(a.v, c.v)::BIGINT AS score
    FROM numbers a, numbers c
    WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


SQL: dict[str, str] = {
    "op2_mixing": _mixing(),
    "op6_kdtree": _KDTREE,
    "op8_quality_rules": _quality_rules(),
    "op9_sharding": _sharding(),
    "op10_licenses": _licenses(),
    "op12_hard_negatives": _HARD_NEGATIVES,
}

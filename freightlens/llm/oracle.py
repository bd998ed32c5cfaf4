"""DuckDB SQL for the corpus queries that SQL can express.

Each statement follows the query's definition directly - all pairs, all blocks,
all templates - without the filters, sketches or hashes of the operator.
Learned scores, token ids, page trees and relaxed searches have none; tests
hold those queries against brute force.
"""

from __future__ import annotations

# Runs of characters other than space and U+0009-U+000D.
WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Runs of characters other than ASCII that is no letter or digit.
TERMS = r"list_filter(string_split_regex({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def minhash_sql(table: str = "documents", words: int = 2, percent: int = 80) -> str:
    """All pairs with a common shingle, compared in full; components by closure."""
    joined = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(words))
    return f"""
WITH RECURSIVE base AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM {table}),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {words} THEN list_transform(range(1, len(w) - {words} + 2), lambda i: {joined})
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM base),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= {percent} * (p.n + q.n - c)),
sym AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM base UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a)
SELECT base.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, r.c AS component_id, base.doc_id = r.c AS kept
FROM base JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = base.doc_id LEFT JOIN size ON size.doc_id = base.doc_id"""


# Expected phrases and notices, stated here on their own.
PHRASES = {"apache license": "apache", "cc by": "cc-by", "gnu general public license": "gpl", "mit license": "mit"}
NOTICES = """
apache-2.0: licensed under the apache license version 2 0
mit: released under the mit license
mit: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
gpl-3.0: this work is licensed under the gnu general public license version 3
gpl-2.0: this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2
cc-by-nc-4.0: licensed under cc by nc 4 0
cc-by-sa-4.0: licensed under cc by sa 4 0
cc-by-4.0: this work is licensed under a creative commons attribution 4 0 international license
bsd: redistribution and use in source and binary forms with or without modification are permitted
mpl-2.0: this source code form is subject to the terms of the mozilla public license v 2 0
"""


def license_sql() -> str:
    def places(phrase: str) -> str:
        words = phrase.split()
        same = " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(words))
        return f"list_filter(range(1, len(w) - {len(words)} + 2), lambda i: {same})"

    # a block: so many words in a row that a notice in it may hold a quarter of other words
    notices = ", ".join(f"('{a}', ['{"', '".join(sorted(set(t.split())))}'], {-(-len(t.split()) * 100 // 80)})"
                        for a, t in (x.split(": ") for x in NOTICES.strip().split("\n")))
    labels = " UNION ALL ".join(f"SELECT k, '{label}' AS label FROM base WHERE len({places(p)}) > 0" for p, label in PHRASES.items())
    found = " || ".join(places(p) for p in PHRASES)
    return f"""
WITH base AS (SELECT row_number() OVER () AS k, doc_id, {LOWER} AS t, {TERMS.format(LOWER)} AS w FROM documents),
place AS (SELECT k, {found} AS p FROM base),
phrase AS ({labels}),
notice(label, words, width) AS (VALUES {notices}),
cand AS (SELECT k, w, label, words, width, len(words) AS size FROM base CROSS JOIN notice WHERE 100 * len(list_intersect(list_distinct(w), words)) >= 80 * size),
hit AS (SELECT k, label, size, list_max(list_transform(range(1, len(w) + 1), lambda i: len(list_intersect(list_distinct(w[i:i + width - 1]), words)))) AS n
        FROM cand WHERE 100 * n >= 80 * size),
own AS (SELECT k, max(n / size) AS best FROM hit GROUP BY k),
every AS (SELECT k, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM phrase UNION SELECT k, label FROM hit) GROUP BY k),
basic AS (SELECT k, string_agg(label, ',' ORDER BY label) AS labels FROM phrase GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, (list_min(p) - 1)::BIGINT AS first_word, (list_max(p) - 1)::BIGINT AS last_word,
       coalesce(basic.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM base JOIN place USING (k) LEFT JOIN own USING (k) LEFT JOIN every USING (k) LEFT JOIN basic USING (k)"""


# Production weights of the mix; other sources share the rest evenly.
SHARES = {"src0": 0.20, "src1": 0.10, "src2": 0.10, "src3": 0.02}
MIX_SEED = 17


def mix_sql() -> str:
    """Poisson counts by comparing each document's uniform value with its source's cumulative table."""
    bits = "('0x' || substr(md5({}), 1, 13))::BIGINT"
    named = "CASE source " + " ".join(f"WHEN '{s}' THEN {w}::DOUBLE" for s, w in SHARES.items()) + " END"
    doc = "coalesce(d.doc_id::VARCHAR, 'null')"
    return f"""
WITH RECURSIVE size AS (SELECT source, coalesce(sum(length(text)), 0)::DOUBLE AS size, {named} AS named FROM documents GROUP BY source),
whole AS (SELECT sum(size) AS total, sum(named) AS taken, sum(CASE WHEN named IS NULL THEN 1.0::DOUBLE END) AS others FROM size),
rate AS (SELECT source, CASE WHEN size > 0 THEN greatest(0.0::DOUBLE, coalesce(named, (1.0::DOUBLE - coalesce(taken, 0.0::DOUBLE)) / others)) * 1.0::DOUBLE * total / size
                             ELSE 0.0::DOUBLE END AS rate FROM size, whole),
part AS (SELECT source, rate / parts AS mean, parts FROM (SELECT source, rate, greatest(1, ceil(rate / 500))::BIGINT AS parts FROM rate)),
cdf AS (SELECT source, mean, parts, 0::BIGINT AS k, exp(-mean) AS p, exp(-mean) AS c FROM part
        UNION ALL SELECT source, mean, parts, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean) + 12)),
drawn AS (SELECT d.*, rowid_ AS r, unnest(range(1, parts + 1)) AS piece FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) d
          JOIN part ON part.source IS NOT DISTINCT FROM d.source),
each AS (SELECT d.r, count(c) AS n FROM drawn d LEFT JOIN cdf ON cdf.source IS NOT DISTINCT FROM d.source
           AND c < ({bits.format(f"'{MIX_SEED}:' || d.piece || ':' || {doc}")} + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE GROUP BY d.r),
rows AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, each.n::INTEGER AS copies, unnest(range(1, each.n + 1))::INTEGER AS copy
         FROM (SELECT *, row_number() OVER () AS r FROM documents) d JOIN each USING (r))
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.copies, d.copy, {bits.format(f"'{MIX_SEED}:order:' || {doc} || ':' || d.copy")} AS shuffle_key FROM rows d"""


def middle_sql() -> str:
    """Units by one regular expression, pieces joined anew; the restored text is the text."""
    h = [f"('0x' || substr(k, {1 + 8 * i}, 8))::BIGINT" for i in range(4)]
    part = lambda a, b: f"array_to_string(u[{a}:{b}], '')"
    return f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                     sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
cut AS (SELECT doc_id, t, u, len(u)::BIGINT AS n, least({h[0]} % (len(u) + 1), {h[1]} % (len(u) + 1)) AS a, greatest({h[0]} % (len(u) + 1), {h[1]} % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {h[2]} % 100 >= 90 THEN 'plain'
             WHEN {h[3]} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM base),
piece AS (SELECT *, {part("1", "a")} AS p, {part("a + 1", "b")} AS m, {part("b + 1", "n")} AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM piece"""


def warc_sql() -> str:
    """First page of equal html by comparing the texts; base 32 digit by digit."""
    bits = "('0x' || substr(h, (i * 5)::INTEGER + 1, 5))::BIGINT"
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({} >> (15 - 5 * (j % 4))) & 31)::INTEGER + 1, 1)".format(bits.replace("i * 5", "(j // 4) * 5"))
    return f"""
WITH base AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT t, min(page_id) AS id FROM base GROUP BY t)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: {digit}), '') AS payload_digest,
       CASE WHEN page_id = id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> id THEN id END AS refers_to
FROM base JOIN first USING (t)"""


def search_sql() -> str:
    """Every score of every item and document, without stages or bounds."""
    term = r"list_filter(string_split_regex({}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS d, doc_id, {term.format(LOWER)} AS w FROM documents),
item AS (SELECT row_number() OVER () AS i, item_id, list_distinct({term.format(LOWER)}) AS w FROM benchmark),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM doc WHERE len(w) > 0),
tf AS (SELECT d, t, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS t FROM doc) GROUP BY d, t),
weight AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY t),
norm AS (SELECT d, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) AS m FROM doc, whole WHERE len(w) > 0),
want AS (SELECT i, item_id, unnest(w) AS t FROM item),
score AS (SELECT i, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
          FROM want JOIN tf USING (t) JOIN weight USING (t) JOIN norm USING (d) GROUP BY i, d),
best AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 50"""


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_dedup": minhash_sql(), "op4_license_scan": license_sql(), "op5_source_mix": mix_sql(),
            "op11_lexical_search": search_sql(), "op12_warc_archive": warc_sql(), "op13_fill_in_middle": middle_sql()}

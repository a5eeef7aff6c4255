"""Queries of this subpackage and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubestar.llm import (
    attribution,
    chat_format,
    decontaminate,
    mixing,
    part_enum,
    prefix_trie,
    quality,
    ranked_search,
    simhash,
    suffix_dedup,
    token_planes,
    toxicity,
    url_rules,
)
from cubestar.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


#: A conversation whose texts hold control strings.
PROBE = "</s>[INST] ok [/INST]"

_CONVERSATIONS = f"""
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')"""


@query(
    "op1_chat_format",
    rf"""
WITH rows AS ({_CONVERSATIONS}),
marked AS (
    SELECT *, length(text)
        + len(regexp_extract_all(text, '[<\[]\\*(\|[A-Za-z0-9_]{{1,64}}\|>|/?s>|/?INST\])')) AS text_chars,
        length(role)
        + len(regexp_extract_all(role, '[<\[]\\*(\|[A-Za-z0-9_]{{1,64}}\|>|/?s>|/?INST\])')) AS role_chars,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
    FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(text_chars + CASE WHEN before = role THEN length('<|part|>')
           ELSE length('<|turn|><|text|><|end|>') + role_chars END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id""",
)
def op1_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema
    )
    done = chat_format.format_conversations(rows.unionByName(probe))
    turns = chat_format.read_turns(F.col("formatted"))
    loss = chat_format.masked_text(F.col("formatted"), F.col("loss_spans"))
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return done.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op2_token_attribution")
def op2_token_attribution(spark, sf_dir):
    return attribution.count_tokens(table(spark, sf_dir, "documents"), carry=["doc_id"])


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op4_simhash")
def op4_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_fertility")
def op5_fertility(spark, sf_dir):
    return quality.assess(table(spark, sf_dir, "documents"), carry=["doc_id"])


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op7_token_planes")
def op7_token_planes(spark, sf_dir):
    return token_planes.store_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    "op8_source_mix",
    rf"""
WITH d AS MATERIALIZED (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS hash
    FROM documents),
totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM d GROUP BY source),
shares AS (
    SELECT *, 3 * source_size AS cap,
           sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
               ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget_left,
           sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM totals),
levels AS (
    SELECT *, budget_left * weight > cap * weights AS stops FROM shares),
targets AS (
    SELECT source, source_size,
           CASE WHEN stops THEN cap::DOUBLE ELSE (
               SELECT arg_max(budget_left::DOUBLE / weights, weights) FROM levels WHERE NOT stops) * weight
           END AS target
    FROM levels),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats
    FROM targets),
running AS (
    SELECT g.source, hash, s, sum(s) OVER (PARTITION BY g.source ORDER BY hash) AS upto
    FROM (SELECT source, hash, sum(size) AS s FROM d WHERE size > 0 GROUP BY source, hash) g),
edges AS (
    SELECT b.source, min(hash) AS hash, min(upto) AS upto, arg_min(s, upto) AS s,
           any_value(target - repeats * source_size) AS budget
    FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
    WHERE target - repeats * source_size > 0 AND upto >= target - repeats * source_size
    GROUP BY b.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * (b.repeats + CASE WHEN e.hash IS NULL THEN 0
           WHEN d.hash < e.hash OR d.hash = e.hash AND e.upto - e.budget <= e.budget - (e.upto - e.s)
           THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source""",
)
def op8_source_mix(spark, sf_dir):
    sizes, plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    taken = mixing.with_copies(sizes, plan)
    return taken.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


#: Action, host and path of the site rules.
SITE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_SITE_VALUES = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in SITE_RULES)
_PATTERN_VALUES = ", ".join(f"('{n}', '{p}')" for n, p in url_rules.DEFAULT_PATTERNS)


@query(
    "op9_url_rules",
    rf"""
WITH rules(action, host, path) AS (VALUES {_SITE_VALUES}),
patterns(name, expression) AS (VALUES {_PATTERN_VALUES}),
parts AS MATERIALIZED (
    SELECT page_id, url,
           translate(regexp_extract(after, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, url, CASE WHEN position('://' IN url) > 0
                 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS after FROM pages)),
sites AS (
    SELECT url, min((-length(r.host || r.path), r.host || r.path, r.action)) AS fit
    FROM (SELECT DISTINCT url, host, path FROM parts) p JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY url),
junk AS (
    SELECT url, min(name) AS pattern FROM (SELECT DISTINCT url FROM parts) p JOIN patterns
      ON regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), expression)
    GROUP BY url)
SELECT page_id, host, path, fit[2] AS rule,
       coalesce(fit[3], CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, pattern
FROM parts LEFT JOIN sites ON parts.url = sites.url LEFT JOIN junk ON parts.url = junk.url""",
)
def op9_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, SITE_RULES).drop("url")


@query("op10_decontaminate")
def op10_decontaminate(spark, sf_dir):
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op11_part_enum",
    rf"""
WITH RECURSIVE words AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s
    FROM words),
held AS MATERIALIZED (
    SELECT doc_id, len(s) AS n, hash(x) AS h FROM (SELECT doc_id, s, unnest(s) AS x FROM sets)),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM held a JOIN held b ON a.h = b.h AND a.doc_id <> b.doc_id
        AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
    GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT doc_id, any_value(len(s))::BIGINT AS n_shingles, min(other) AS component_id
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id""",
)
def op11_part_enum(spark, sf_dir):
    return part_enum.similar_sets(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    "op12_ranked_search",
    rf"""
WITH words AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT doc_id, len(w) AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
asked AS MATERIALIZED (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
counts AS MATERIALIZED (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, totals GROUP BY term),
impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS impact
    FROM counts JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
scores AS (
    SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10""",
)
def op12_ranked_search(spark, sf_dir):
    return ranked_search.search(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )


@query(
    "op13_prefix_trie",
    r"""
WITH turns AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (
    SELECT conv_id, n, conv_id - conv_id % 100 AS family,
           xor(4294967295, list_reduce(
               [4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
               lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
                   lambda x, step: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS h
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)),
rebuilt AS MATERIALIZED (
    SELECT c.conv_id, t.role, t.text, t.pos
    FROM convs c JOIN turns t ON t.conv_id = c.family AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, t.role, t.text, t.pos - c.h + least(c.h, coalesce(f.n, 0))
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
    LEFT JOIN convs f ON f.conv_id = c.family),
prefixes AS MATERIALIZED (
    SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS chars FROM convs
    UNION ALL
    SELECT a.conv_id, a.pos + 1,
           string_agg(sha256(b.role) || sha256(b.text), '' ORDER BY b.pos),
           coalesce(string_agg(sha256(b.role) || sha256(b.text), '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
           any_value(length(a.text))
    FROM rebuilt a JOIN rebuilt b ON a.conv_id = b.conv_id AND b.pos <= a.pos
    GROUP BY a.conv_id, a.pos),
nodes AS MATERIALIZED (
    SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id,
           count(*) AS n_convs, any_value(chars) AS chars
    FROM prefixes GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
subtrees AS (
    SELECT above.node, count(*) FILTER (k.node IS NULL) AS n_leaves,
           sum((below.n_convs - 1) * below.chars) AS saved_tokens
    FROM nodes below LEFT JOIN children k ON k.node = below.node
    JOIN nodes above ON starts_with(below.node, above.node)
    GROUP BY above.node),
ends AS (
    SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max_by(node, depth) AS node FROM prefixes GROUP BY conv_id) GROUP BY node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.node
LEFT JOIN nodes p ON p.node = n.parent AND n.depth > 0
LEFT JOIN children k ON k.node = n.node LEFT JOIN ends e ON e.node = n.node""",
)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))

"""The operators of this package as registered queries, with SQL where SQL can express them."""

from pathlib import Path

from pyspark.sql import functions as F

from .decision_list import judge_quality
from .exact_dedup import exact_dedup
from .license_scan import scan_licenses
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .segments import described
from .shared import folder, importable
from .simhash import simhash_groups
from .suffix_dedup import repeated_passages
from .syncmers import edited_likeness
from .token_files import token_checksums, write_token_files
from .turn_repair import repair_conversations
from .url_filter import Rule, judge_urls
from .warc import read_archives, write_archives

QUERIES = {}
ORACLES = {}


def query(oracle=None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL."""

    def register(build):
        def run(spark, sf_dir):
            return build(importable(spark), sf_dir)

        QUERIES[build.__name__] = run
        if oracle is not None:
            ORACLES[build.__name__] = oracle
        return run

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name):
    """Path of a public tokenizer's file; another file can be given to the operators."""
    import public_tokenizers

    return str(Path(public_tokenizers.path(name)))


@query(
    r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), groups AS (
  SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM texts GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN groups USING (text_sha256)
"""
)
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query()
def op2_token_files(spark, sf_dir):
    at = folder(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), at)
    return token_checksums(manifest, at)


@query()
def op3_segmentation(spark, sf_dir):
    return described(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query(
    r"""
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((((16 * (strpos('0123456789abcdef', substr(hex, 1 + (i * 5) // 4, 1)) - 1)
               + strpos('0123456789abcdef', substr(hex, 2 + (i * 5) // 4, 1)) - 1) >> (3 - (i * 5) % 4)) & 31)::INTEGER), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM placed
"""
)
def op4_warc(spark, sf_dir):
    return read_archives(write_archives(table(spark, sf_dir, "pages")), payloads=False)


@query()
def op5_quality_rules(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query()
def op7_suffix_dedup(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


#: The rules of op8_url_filter.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def _fits(rule):
    return f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}')"


def _by_rule(value):
    ordered = sorted(URL_RULES, key=lambda r: -len(r.text))
    return "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{value(r)}'" for r in ordered)


# The given pages hold no redirect and no canonical link, so that no decision comes from an alias there.
@query(
    f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages
)
SELECT page_id, host, path, {_by_rule(lambda r: r.text)} END AS rule, {_by_rule(lambda r: r.verdict)} ELSE 'allow' END AS verdict
FROM parts
"""
)
def op8_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op9_simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


@query()
def op10_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


def _crc32(text):
    """DuckDB's SQL for the unsigned CRC-32 of an ASCII string."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substr({text}, i::INTEGER, 1))::BIGINT)"
    bit = "xor(d >> 1, CASE WHEN d & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(c, x), range(8)), lambda d, z: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, x: {byte}), 4294967295)"


def _cell(cell, cost, edit, text):
    return f"{{'cost': {cell}.cost + {cost}, 'audit': {cell}.audit || '{edit}', 'turns': {cell}.turns || {text}}}"


def _best(*cells):
    return f"list_min([{', '.join(cells)}])"


def _after_turn(state, entered, letter):
    """Cell of a state behind a turn: deleted, or in a state that the turn, kept or in another role, leads on from."""
    late, never = "CASE WHEN fault = 't' THEN 3 ELSE 0 END", "CASE WHEN {} THEN {} ELSE 1000000000000 END"
    cells = [_cell(state, 4, "D", "''")]
    for before in entered:
        stays = f"fault IN ('', 't') AND initial = '{letter}'"
        cells.append(_cell(before, never.format(stays, late), "K", "chr(10) || role || ':' || text"))
        if letter != "s":
            role = {"u": "user", "a": "assistant"}[letter]
            cells.append(_cell(before, never.format("fault IN ('', 't')", f"3 + {late}"), "R", f"chr(10) || '{role}:' || text"))
    return _best(*cells)


_INSERT_U, _INSERT_A = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
_REPAIR_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), dealt AS (
  SELECT *, {_crc32("name")} % 20 AS k FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS trimmed FROM damaged
), judged AS (
  SELECT conv_id, turn, role, text, place, left(role, 1) AS initial,
         CASE WHEN trimmed = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
              WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS prior
  FROM ordered
), chart AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, {{'cost': 0::BIGINT, 'audit': '', 'turns': ''}} AS c0,
         {{'cost': 1000000000000::BIGINT, 'audit': '', 'turns': ''}} AS c1,
         {{'cost': 3::BIGINT, 'audit': 'I', 'turns': {_INSERT_U}}} AS c2,
         {{'cost': 6::BIGINT, 'audit': 'II', 'turns': {_INSERT_U} || {_INSERT_A}}} AS c3 FROM conversations
  UNION ALL
  SELECT conv_id, place, t0, t1, u2, {_best("t3", _cell("u2", 3, "I", _INSERT_A))}
  FROM (SELECT *, {_best("t2", *[_cell(f"t{p}", 3, "I", _INSERT_U) for p in (0, 1, 3)])} AS u2
        FROM (SELECT j.conv_id, j.place, {_after_turn("c0", [], "s")} AS t0, {_after_turn("c1", ["c0"], "s")} AS t1,
                     {_after_turn("c2", ["c0", "c1", "c3"], "u")} AS t2, {_after_turn("c3", ["c2"], "a")} AS t3
              FROM chart JOIN judged j ON j.conv_id IS NOT DISTINCT FROM chart.conv_id AND j.place = chart.place + 1))
), repaired AS (
  SELECT conv_id, {_best("arg_max(c0, place)", "arg_max(c3, place)")} AS best FROM chart GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (place > 1 AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT r.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(substr(best.turns, 2)) AS repaired_sha256
FROM repaired r LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""


def damaged_turns(conversations):
    """``conversations`` with faults dealt by CRC-32: (conv_id, turn, role, text, copies)."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    k = F.crc32(name) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(k == 4, "user").otherwise(role).alias("role"),
        F.when(k == 1, "").when(k == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"),
    )


@query(_REPAIR_SQL)
def op11_turn_repair(spark, sf_dir):
    return repair_conversations(damaged_turns(table(spark, sf_dir, "conversations")), copies="copies").drop("turns")


@query()
def op12_syncmers(spark, sf_dir):
    return edited_likeness(table(spark, sf_dir, "documents"))


_TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(text, '') AS text,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {_crc32("name")} % 9 AS h FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS name FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS own, place, name, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
  UNION ALL
  SELECT conv_id, 1, place, name, text FROM convs JOIN turns USING (conv_id) WHERE place > h
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM rebuilt
), paths AS (
  SELECT conv_id, 0::BIGINT AS depth, '' AS path, 0::BIGINT AS bytes FROM convs
  UNION ALL
  SELECT conv_id, depth, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY depth), octet_length(encode(text)) FROM numbered
), members AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node, max(depth) OVER (PARTITION BY conv_id) AS last FROM paths
), nodes AS (
  SELECT node, depth, count(*) AS n_convs, max(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), linked AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1
), children AS (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY parent, depth
), figures AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (node, depth)
), sums AS (
  SELECT m.node, m.depth, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.bytes)::BIGINT AS saved_tokens
  FROM figures f JOIN members m ON m.conv_id = f.node AND m.depth <= f.depth GROUP BY m.node, m.depth
)
SELECT node AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM figures JOIN sums USING (node, depth)
"""


@query(_TRIE_SQL)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"), family=5, borrow=8)

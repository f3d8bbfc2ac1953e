"""The operators as queries over the given tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from buildlens.llm import (
    byte_bpe,
    class_lm,
    html_text,
    language_id,
    licenses,
    merkle,
    mixing,
    near_duplicates,
    rule_ledger,
    secret_scan,
    simhash,
    top_k,
    whitening,
)
from buildlens.llm.common import table


def op1_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_top_k(spark, sf_dir):
    return top_k.search(table(spark, sf_dir, "embeddings"))


def op4_class_lm(spark, sf_dir):
    return class_lm.scores(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark, sf_dir):
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op6_rule_ledger(spark, sf_dir):
    return rule_ledger.verdicts(table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_licenses(spark, sf_dir):
    return licenses.found(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark, sf_dir):
    return near_duplicates.components(table(spark, sf_dir, "documents"))


def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark, sf_dir):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return merkle.manifest(table(spark, sf_dir, "documents")).select(*columns)


def op13_simhash(spark, sf_dir):
    return simhash.components(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_text,
        op2_language_id,
        op3_top_k,
        op4_class_lm,
        op5_secret_scan,
        op6_rule_ledger,
        op7_mixing,
        op8_byte_bpe,
        op9_licenses,
        op10_near_duplicates,
        op11_whitening,
        op12_merkle_manifest,
        op13_simhash,
    )
}

# the rules of the current policy, spelled out
_OP6 = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(ws, i, i + 4) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM words)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), measured AS (
  SELECT words.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(regexp_extract_all(text, '\p{Lu}')) AS n_capitals
  FROM words LEFT JOIN covered ON covered.doc_id = words.doc_id
), judged AS (
  SELECT *, CAST(
      CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 14 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_capitals > word_chars THEN 64 ELSE 0 END AS BIGINT) AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM judged
"""

_OP3 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v AS q, v AS c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""

def _tree_sql(nodes: str, name: str, levels: int) -> str:
    """Tables <name>1 ... of runs: grp, run, ds (their digests in order), digest, width of the next level."""
    out = []
    for k in range(1, levels + 1):
        out.append(f"""{name}{k} AS MATERIALIZED (
  SELECT grp, slot // 16 AS slot, list(digest ORDER BY slot) AS ds, (any_value(width) + 15) // 16 AS width,
         sha256(string_agg(digest, '' ORDER BY slot)) AS digest
  FROM {nodes} WHERE width > 1 GROUP BY grp, slot // 16
)""")
        nodes = f"{name}{k}"
    return ",\n".join(out)


def _manifest_sql(levels: int = 6) -> str:
    """Up to 16 ** levels rows of a source, and as many sources."""

    def field(c: str, size: str) -> str:
        return f"coalesce(strlen({size}) || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        parts = [field(c, f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")] + [field(text, text)]
        return f"sha256({' || '.join(parts)})"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tops = " UNION ALL ".join(f"SELECT grp, digest FROM {x} WHERE width = 1" for x in ["leaves", *[f"s{k}" for k in range(1, levels + 1)]])
    roots = " UNION ALL ".join(f"SELECT digest FROM {x} WHERE width = 1" for x in ["subroots", *[f"r{k}" for k in range(1, levels + 1)]])
    steps = [("s", k, "leaves.grp", "leaves.slot") for k in range(1, levels + 1)]
    steps += [("r", k, "0", "subroots.slot") for k in range(1, levels + 1)]
    joins, siblings, fold = [], [], ""
    for name, k, grp, slot in steps:
        joins.append(f"LEFT JOIN {name}{k} ON {name}{k}.grp = {grp} AND {name}{k}.slot = {slot} // {16**k}")
        i = f"({slot} // {16 ** (k - 1)}) % 16"
        before = f"array_to_string({name}{k}.ds[1:{i}], '')"
        after = f"array_to_string({name}{k}.ds[{i} + 2:], '')"
        siblings.append(f"{before} AS {name}{k}_before, {after} AS {name}{k}_after")
    for at, (name, k, _, _) in enumerate(steps):
        fold += f""",
     fold{at} AS (SELECT *, CASE WHEN {name}{k}_before IS NULL THEN f{at} ELSE sha256({name}{k}_before || f{at} || {name}{k}_after) END
                  AS f{at + 1} FROM {f"fold{at - 1}" if at else "paths"})"""
    proof = " || ".join(f"coalesce({name}{k}_before || {name}{k}_after, '')" for name, k, _, _ in steps)
    return f"""
WITH checked AS (
  SELECT *, xor(list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)],
                  flatten([[CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST(doc_id AS VARCHAR), '')])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 5 = 0 AS chosen
  FROM documents
), hashed AS (
  SELECT doc_id, source, {leaf("text")} AS leaf,
         CASE WHEN chosen THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} END AS tampered
  FROM checked
), leaves AS MATERIALIZED (
  SELECT doc_id, leaf, leaf AS digest, coalesce(tampered, leaf) AS altered,
         CASE WHEN source IS NULL THEN 0 ELSE dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) END AS grp,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot,
         count(*) OVER (PARTITION BY source) AS width
  FROM hashed
), {_tree_sql("leaves", "s", levels)},
subroots AS MATERIALIZED (
  SELECT 0 AS grp, grp AS name, digest, row_number() OVER (ORDER BY grp) - 1 AS slot, count(*) OVER () AS width
  FROM ({tops})
), {_tree_sql("subroots", "r", levels)},
root AS ({roots}),
paths AS (
  SELECT doc_id, leaf, subroots.digest AS subroot, root.digest AS root, altered AS f0,
         {", ".join(siblings)}
  FROM leaves JOIN subroots ON subroots.name = leaves.grp CROSS JOIN root
  {" ".join(joins)}
){fold}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, f{len(steps)} AS folded_root, f{len(steps)} = root AS verified
FROM fold{len(steps) - 1}
"""


ORACLES: dict[str, str] = {"op3_top_k": _OP3, "op6_rule_ledger": _OP6, "op12_merkle_manifest": _manifest_sql()}

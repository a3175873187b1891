"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoria.llm import chat, decontaminate, langid, licenses, lm, minhash, mixing, pii, prefix_trie, ranked_search, secret_scan, simhash, topk
from scoria.llm.common import col, crc_mod5, table
from scoria.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    """Licence phrases and passages in every document."""
    docs = table(spark, sf_dir, "documents")
    texts = [*licenses.PHRASES, *(p for p, _ in licenses.PASSAGES.values())]
    index = licenses.Index(*licenses.document_frequencies(docs, {w for t in texts for w in t.split()}))
    got = licenses.scan(docs, index)
    base = F.filter("hits", lambda h: h["kind"] == "phrase")
    starts = F.transform(base, lambda h: h["start"])
    names = lambda hs: F.array_join(F.array_sort(F.array_distinct(F.transform(hs, lambda h: h["label"]))), ",")
    return got.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                      F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      names(base).alias("base_labels"), names(F.col("hits")).alias("labels"),
                      F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0)).alias("score"))


OP2_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op2_exact_top_k", OP2_SQL)
def op2_exact_top_k(spark, sf_dir):
    """The 20 largest quantised inner products of every 20th vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, CASE WHEN regexp_matches(text, '[<\[]\\*(s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|ASST\]|ROLE:|/ROLE\])')
            THEN len(regexp_replace(text, '([<\[])(\\*)(s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|ASST\]|ROLE:|/ROLE\])',
                                    '\1\\\2\3', 'g')) ELSE len(text) END AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(n + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 14 WHEN 'system' THEN 18 ELSE 19 + len(role) END)
            AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op3_chat_format", OP3_SQL)
def op3_chat_format(spark, sf_dir):
    """All conversations and one that says control strings (rows that the table has under its id, -1, are its turns too),
    formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)],
                                "conv_id long, turn long, role string, text string")
    return chat.digests(chat.segments(turns.unionByName(own)))


@query("op4_lm_score")
def op4_lm_score(spark, sf_dir):
    """Unigram and automaton log10-probabilities of every document, learnt from four fifths of the ids."""
    got = lm.score(table(spark, sf_dir, "documents"), crc_mod5() != 1)
    return got.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _joined(spans, kinds):
    """kind:start:end of sorted spans, comma-joined."""
    name = lambda x: F.element_at(F.array(*[F.lit(k) for k in kinds]), x["k"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"),
                                                                 x["end"].cast("string"))), ",")


def _count(spans, k):
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")


@query("op5_pii_bootstrap")
def op5_pii_bootstrap(spark, sf_dir):
    """Base personal data and what bootstrapped contexts add, in every document."""
    got = pii.extract(table(spark, sf_dir, "documents"))
    every = F.array_sort(F.array_distinct(F.concat("base", "added")))
    return got.select("doc_id", *[_count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
                      F.sha2(_joined(F.col("base"), pii.KINDS).cast("binary"), 256).alias("base_sha256"),
                      _joined(every, pii.KINDS).alias("spans"))


@query("op6_simhash_dedup")
def op6_simhash_dedup(spark, sf_dir):
    """3-word SimHash of every document, linked within 2 bits."""
    got = simhash.groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    """Compression classifier fitted on four fifths of the labelled ids, applied to every document."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, crc_mod5() != 0)
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod5() == 0).alias("held_out"),
                      langid.identify(col("text"), model).alias("p"))
    return got.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                      F.col("p.margin").alias("margin"), F.col("p.rejected").alias("rejected"))


def _op7_kind(k, name, pattern, value, keep):
    """Places of one kind: list arithmetic over what stands between and in the matches."""
    return f"""
  SELECT rid, doc_id, source, {k} AS k, '{name}' AS kind, unnest([{{'s': list_sum(gap[1:i]) + coalesce(list_sum(n[1:i - 1]), 0),
         'n': n[i], 'v': v[i]}} FOR i IN range(1, len(n) + 1)]) AS m
  FROM (SELECT rid, doc_id, source, [len(x) FOR x IN string_split_regex(text, '{pattern}')] AS gap,
               [len(x) FOR x IN regexp_extract_all(text, '{pattern}')] AS n,
               regexp_extract_all(text, '{pattern}', {value}) AS v
        FROM d WHERE regexp_matches(text, '{pattern}')) WHERE true{keep}"""


OP7_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS (""" + " UNION ALL ".join(_op7_kind(k, name, pattern.replace("'", "''"), group, "")
                               for k, (name, (pattern, group, _, _)) in enumerate(secret_scan.KINDS.items())) + """),
c AS (
  SELECT rid, doc_id, source, k, kind, CAST(m.s AS BIGINT) AS s, CAST(m.s + m.n AS BIGINT) AS e, m.v AS v FROM m
  WHERE len(m.v) >= ([8, 16, 32, 24])[k + 1] AND (k < 3 OR (regexp_matches(m.v, '[a-z]') AND regexp_matches(m.v, '[A-Z]')
        AND regexp_matches(m.v, '[0-9][^0-9]*[0-9][^0-9]*[0-9]')))),
p AS (
  SELECT * FROM c WHERE k < 3 OR NOT EXISTS (
    SELECT 1 FROM c b WHERE b.rid = c.rid AND b.k < 3 AND b.s < c.e AND b.e > c.s)),
o AS (SELECT v, count(DISTINCT coalesce('0' || source, '1')) AS owners,
             count(DISTINCT coalesce('0' || doc_id, '1')) AS repos FROM p GROUP BY v),
r AS (SELECT * FROM (SELECT p.*, owners <= MAX_OWNERS AND repos <= MAX_REPOS AS live FROM p JOIN o USING (v)) WHERE k < 3 OR live),
a AS (
  SELECT rid, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex, count(*) FILTER (WHERE live) AS n_live,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM r GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN a USING (rid)
""".replace("MAX_OWNERS", str(secret_scan.MAX_OWNERS)).replace("MAX_REPOS", str(secret_scan.MAX_REPOS))


@query("op7_secret_scan", OP7_SQL)
def op7_secret_scan(spark, sf_dir):
    """Secrets in every document; values that few owners and repositories hold count as live."""
    got = secret_scan.scan(table(spark, sf_dir, "documents"))
    kinds = list(secret_scan.KINDS)
    base = F.filter("spans", lambda x: x["base"])
    return got.select("doc_id", *[_count(F.col("spans"), k).alias(f"n_{kinds[k]}") for k in range(3)],
                      F.sha2(_joined(base, kinds).cast("binary"), 256).alias("base_sha256"),
                      _joined(F.col("spans"), kinds).alias("spans"),
                      F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"))


OP7_OWNERSHIP_SQL = OP7_SQL.partition("\no AS (")[0] + f"""
o AS (SELECT v, count(DISTINCT coalesce('0' || source, '1')) AS owners,
             count(DISTINCT coalesce('0' || doc_id, '1')) AS repos FROM p GROUP BY v),
r AS (SELECT p.*, owners, repos, owners <= {secret_scan.MAX_OWNERS} AND repos <= {secret_scan.MAX_REPOS} AS live FROM p JOIN o USING (v))
SELECT doc_id, kind, s AS "start", e AS "end", owners, repos, live FROM r WHERE k < 3 OR live
"""


@query("op7_secret_ownership", OP7_OWNERSHIP_SQL)
def op7_secret_ownership(spark, sf_dir):
    """The spans of op7_secret_scan, one a row, with the distinct owners and repositories of their value."""
    got = secret_scan.scan(table(spark, sf_dir, "documents")).select("doc_id", F.explode("spans").alias("x"))
    name = F.element_at(F.array(*[F.lit(k) for k in secret_scan.KINDS]), F.col("x.k") + 1)
    return got.select("doc_id", name.alias("kind"), "x.start", "x.end", "x.owners", "x.repos", "x.live")


OP8_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
ia AS (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS a FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[a:a + 9], ' ') AS phrase FROM ia),
da AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS a FROM dw),
dn AS (SELECT rid, a, n, array_to_string(w[a:a + n - 1], ' ') AS phrase
       FROM da, (SELECT DISTINCT n FROM win) WHERE a + n - 1 <= len(w)),
met AS (SELECT rid, a, dn.n, item_id FROM dn JOIN win ON dn.n = win.n AND dn.phrase = win.phrase),
hit AS (SELECT rid, count(*) AS n_hit FROM
        (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(a, a + n)) AS p FROM met)) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
        FROM (SELECT DISTINCT rid, item_id FROM met) GROUP BY rid),
low AS (SELECT rid, w, [lower(x) FOR x IN w] AS l FROM dw),
wl AS (SELECT rid, unnest(range(0, len(l))) AS p, unnest(l) AS t FROM low WHERE len(l) > 0),
ph AS (SELECT DISTINCT phrase, n, [lower(x) FOR x IN string_split(phrase, ' ')] AS ts FROM win),
pt AS (SELECT phrase, n, unnest(range(0, len(ts))) AS off, unnest(ts) AS t FROM ph),
pc AS (SELECT t, count(*) AS places FROM wl WHERE t IN (SELECT t FROM pt) GROUP BY t),
rk AS (SELECT phrase, n, off, t, row_number() OVER (PARTITION BY phrase ORDER BY coalesce(places, 0), off, t) AS i
       FROM pt LEFT JOIN pc USING (t)),
ky AS (SELECT a.phrase, a.n, a.t AS t, a.off AS off, b.t AS t2, b.off AS off2
       FROM rk a JOIN rk b ON a.phrase = b.phrase AND a.i < b.i AND b.i <= 3),
nr AS (SELECT DISTINCT x.rid, ky.phrase, ky.n, x.p - ky.off AS st
       FROM wl x JOIN ky ON x.t = ky.t
       JOIN wl y ON y.rid = x.rid AND y.t = ky.t2 AND y.p <> x.p AND abs(y.p - (x.p - ky.off + ky.off2)) <= SLACK),
nd AS (SELECT nr.rid, nr.phrase FROM nr JOIN low USING (rid) JOIN ph ON ph.phrase = nr.phrase
       LEFT JOIN (SELECT DISTINCT rid, a - 1 AS st, phrase FROM dn JOIN ph USING (phrase)) e
         ON e.rid = nr.rid AND e.phrase = nr.phrase AND e.st = nr.st
       WHERE e.rid IS NULL AND len(list_intersect(ts, l[greatest(nr.st - SLACK, 0) + 1:nr.st + nr.n + SLACK])) >=
             ceil(MIN_SHARE * len(list_distinct(ts)))),
ns AS (SELECT rid, count(*) AS n_near FROM nd GROUP BY rid),
ni AS (SELECT rid, count(*) AS n_near_items, string_agg(item_id, ',' ORDER BY item_id) AS near_items
       FROM (SELECT DISTINCT rid, item_id FROM nd JOIN win USING (phrase)) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
       coalesce(n_near, 0) AS n_near, coalesce(n_near_items, 0) AS n_near_items, coalesce(near_items, '') AS near_items
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid) LEFT JOIN ns USING (rid) LEFT JOIN ni USING (rid)
""".replace("SLACK", str(decontaminate.SLACK)).replace("MIN_SHARE", str(decontaminate.MIN_SHARE))


@query("op8_decontamination", OP8_SQL)
def op8_decontamination(spark, sf_dir):
    """Exact 10-word windows of the benchmark in every document and places that nearly hold one, by the positional index."""
    docs = table(spark, sf_dir, "documents")
    return _op8_rows(docs, *decontaminate.near_report(docs, table(spark, sf_dir, "benchmark")))


def _op8_rows(docs, found, near):
    """A row per document: the exact columns and those of the proximity matches."""
    same = lambda t: F.col("d.doc_id").eqNullSafe(F.col(f"{t}.doc_id")) & (F.col("d.h") == F.col(f"{t}.h"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"),
                    F.size(decontaminate.words(col("text"))).cast("long").alias("n_words")).alias("d")
    both = d.join(found.alias("f"), same("f"), "left").join(near.alias("g"), same("g"), "left")
    return both.select(
        "d.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("item_ids", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce(F.size("near_ids"), F.lit(0)).cast("long").alias("n_near_items"),
        F.coalesce(F.array_join("near_ids", ","), F.lit("")).alias("near_items"))


@query("op8_near_decontamination", OP8_SQL)
def op8_near_decontamination(spark, sf_dir):
    """op8_decontamination under its earlier name."""
    return op8_decontamination(spark, sf_dir)


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[r % 3 + 1] AS w, ([-0.5, 0.0, 0.5])[r % 3 + 1]::DOUBLE AS a FROM s),
lev AS (
  SELECT 2.0 * source_size / w AS ratio,
         (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER
            (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT *, least(2.0 * source_size, w * (SELECT level FROM lev WHERE level <= ratio ORDER BY ratio LIMIT 1))::DOUBLE AS target FROM w),
c AS (
  SELECT d.doc_id, size, source_size, target, a,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS st
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, CAST(greatest(0, least(size, CAST(round(target) AS BIGINT) - st))
         + greatest(0, least(size, CAST(round(target) AS BIGINT) - st - source_size)) AS BIGINT) AS taken FROM c)
SELECT doc_id, size, source_size, round(target, 6) AS target, taken,
       CASE WHEN taken = 0 THEN NULL WHEN a = 0 THEN round(st / target, 6)
            ELSE round((a - 1 + sqrt((1 - a) * (1 - a) + 4 * a * (st / target))) / (2 * a), 6) END AS position
FROM k
"""


@query("op10_curriculum_mix", OP10_SQL)
def op10_curriculum_mix(spark, sf_dir):
    """Every document's share of the mix and the training position of its first copy."""
    got = mixing.mix(table(spark, sf_dir, "documents"))
    return got.drop("positions", "text_hash").withColumns({"target": F.round("target", 6), "position": F.round("position", 6)})


OP10_COPIES_SQL = OP10_SQL.partition("\nk AS (")[0] + """
l AS (
  SELECT *, st + lap * source_size AS place,
         CAST(greatest(0, least(size, CAST(round(target) AS BIGINT) - st - lap * source_size)) AS BIGINT) AS part
  FROM c, (SELECT unnest([0, 1]) AS lap))
SELECT doc_id, size, source_size, round(target, 6) AS target, CASE WHEN part > 0 THEN lap + 1 END AS copy, part AS taken,
       CASE WHEN part = 0 THEN NULL WHEN a = 0 THEN round(place / target, 6)
            ELSE round((a - 1 + sqrt((1 - a) * (1 - a) + 4 * a * (place / target))) / (2 * a), 6) END AS position
FROM l WHERE part > 0 OR lap = 0
"""


@query("op10_curriculum_copies", OP10_COPIES_SQL)
def op10_curriculum_copies(spark, sf_dir):
    """The mix as it is trained on: a row per copy of a document, by training position."""
    got = mixing.copies(table(spark, sf_dir, "documents"))
    return got.drop("text_hash").withColumns({"target": F.round("target", 6), "position": F.round("position", 6)})


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
         substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list({'k': key, 'w': w} ORDER BY turn NULLS FIRST, key, w) AS t FROM t GROUP BY conv_id),
c AS (  -- crc32 by bits: each byte is added, then shifted out eight times
  SELECT conv_id, t, CAST(xor(list_reduce(list_concat([4294967295::BIGINT], flatten(
           [[unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')])),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS INT) AS h
  FROM s),
r AS (
  SELECT c.conv_id, list_concat(CASE WHEN c.h > 0 THEN coalesce(b.t, [])[1:c.h] ELSE [] END, c.t[c.h + 1:]) AS t
  FROM c LEFT JOIN s b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, len(t) AS len, [x.k FOR x IN t] AS ks, [x.w FOR x IN t] AS ws FROM r),
e AS (SELECT conv_id, len, ks, ws, unnest(range(0, len + 1)) AS depth FROM p),
n AS (
  SELECT array_to_string(ks[1:depth], '') AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(CASE WHEN depth > 0 THEN array_to_string(ks[1:depth - 1], '') END) AS parent,
         (count(*) - 1) * max(CASE WHEN depth > 0 THEN ws[depth] ELSE 0 END) AS own,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len = depth), '')) AS ends_sha256
  FROM e GROUP BY 1, 2),
kids AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
a AS (SELECT substr(n.node, 1, 32 * u) AS node, own, kids.node IS NULL AS leaf
      FROM (SELECT *, unnest(range(0, depth + 1)) AS u FROM n) n LEFT JOIN kids ON kids.node = n.node),
s2 AS (SELECT node, sum(own) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM a GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s2 USING (node) LEFT JOIN kids USING (node) LEFT JOIN n up ON up.node = n.parent AND n.depth > 0
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark, sf_dir):
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (
  SELECT item_id, text, list_distinct(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
qt AS (SELECT item_id, text, unnest(w) AS term FROM q),
p AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf
      FROM (SELECT rid, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY term, n_docs),
s AS (
  SELECT item_id, text, rid, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM qt JOIN p USING (term) JOIN f USING (term), g GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""


@query("op13_ranked_search", OP13_SQL)
def op13_ranked_search(spark, sf_dir):
    """The ten best documents for the words of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_minhash_dedup")
def op12_minhash_dedup(spark, sf_dir):
    """Components of documents whose 3-word shingle sets have a similarity of 0.85 or more."""
    got = minhash.groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

"""The registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm import (
    alignment,
    chat,
    decontaminate,
    exact,
    importance,
    katz,
    language,
    mixing,
    repeats,
    secrets,
    simhash,
    tokens,
    toxicity,
)
from gridstats.shared import kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", toxicity.held_out(F.col("doc_id"), 5, 0))
    model = toxicity.train_toxicity(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", toxicity.held_out(F.col("doc_id"), 4, 2))
    model = language.train_languages(docs.where(~F.col("held_out")))
    found = docs.select("doc_id", "held_out", model.predict(F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(decontaminate.item_list(F.col("items")), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.held_out(F.col("doc_id"), 7, 2)
    scored = katz.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


CHAT_PROBE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CHAT_PROBE).alias("text"),
    )
    made = chat.format_conversations(turns.unionByName(probe))
    read = made.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.trained_text(F.col("segments")).alias("trained"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lengths = tokens.length_histogram(docs, tokens.encoded_length(F.col("text")))
    return tokens.suffix_sums(kept(lengths, "lengths"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.size("spans").cast("bigint").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", spans, "kept_sha256")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = importance.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.KINDS))

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{secrets.KINDS[kind]}")

    return found.select(
        "doc_id",
        *[number(k) for k in range(len(secrets.KINDS))],
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_katz_scores": op4_katz_scores,
    "op5_chat_format": op5_chat_format,
    "op6_token_counts": op6_token_counts,
    "op9_repeats": op9_repeats,
    "op7_exact_dedup": op7_exact_dedup,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op8_mix_sources": op8_mix_sources,
    "op11_align_tokens": op11_align_tokens,
    "op12_secrets": op12_secrets,
    "op13_importance": op13_importance,
}

_WORD = r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+"
_UPPER, _LOWER = decontaminate.UPPER, decontaminate.LOWER

_DECONTAMINATE = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
  FROM benchmark
), known AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM item WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM known) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, n, item_id FROM places JOIN known USING (n, k)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def _escaped(text: str) -> str:
    t = chat.ChatTemplate()
    for opener in sorted({s[0] for s in t.controls}):
        bodies = "|".join(s[1:].replace("|", r"\|").replace("]", r"\]") for s in t.controls if s[0] == opener)
        found = opener if opener == "<" else rf"\{opener}"
        text = rf"regexp_replace({text}, '{found}(\\*)({bodies})', '{opener}\1\\\2', 'g')"
    return text


_T = chat.ChatTemplate()
_CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CHAT_PROBE}'
  UNION ALL SELECT -1, 1, 'assistant', '{CHAT_PROBE}'
), placed AS (
  SELECT *, row_number() OVER w AS n,
         coalesce(lag(role) OVER w = role, FALSE) AS more
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{_T.trained_role}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = '{_T.trained_role}'), '')) AS loss_sha256,
       CAST(sum(length({_escaped("text")})
           + CASE WHEN more THEN {len(_T.part)}
                  ELSE {len(_T.start + _T.head + _T.end)} + length({_escaped("role")}) END) AS BIGINT)
           AS formatted_chars
FROM placed GROUP BY conv_id"""

_EXACT = r"""
WITH doc AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x{20}\x{09}-\x{0D}]+', ' ', 'g') AS t FROM documents
), class AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM doc GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM doc JOIN class USING (t)"""

def _features(table_name: str, key: str) -> str:
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}')"
    return f"SELECT {key} AS id, {words} AS w FROM {table_name}"


_RUNS = "unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f"
_IMPORTANCE = f"""
WITH doc AS ({_features("documents", "doc_id")}), item AS ({_features("benchmark", "item_id")}),
doc_f AS (SELECT id, {_RUNS} FROM doc), item_f AS (SELECT id, {_RUNS} FROM item),
crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), bytes AS (
  SELECT f, list_transform(range(len(h) // 2), lambda j: CAST('0x' || substr(h, 2 * j + 1, 2) AS BIGINT)) AS b
  FROM (SELECT f, hex(f) AS h FROM (SELECT f FROM doc_f UNION SELECT f FROM item_f))
), hashed AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
                            lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc
), raw AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS n FROM doc_f JOIN hashed USING (f) GROUP BY bucket),
target AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS n FROM item_f JOIN hashed USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM raw) + 10000)
           / ((raw.n + 1) * (coalesce((SELECT sum(n) FROM target), 0) + 10000)))) AS g
  FROM raw LEFT JOIN target t USING (bucket)
), weighed AS (
  SELECT id, count(*) AS n_features, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
  FROM doc_f JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY id
), scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM doc LEFT JOIN weighed USING (id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""

def _either_case(pattern: str) -> str:
    """A pattern with words in small letters, for A-Z in either case; letters beyond ASCII never match."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


_ASSIGN = (
    f"({_either_case('password|passwd|secret|token|api_?key')})"
    r"""["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _found(pattern: str) -> str:
    """Lists of starts, ends and texts of the matches."""
    found, between = f"regexp_extract_all(t, '{pattern}')", f"string_split_regex(t, '{pattern}')"
    return f"""SELECT doc_id, unnest(list_transform(range(1, len(f) + 1), lambda i: {{'f': f[i], 's': CAST(
        list_sum(list_transform(b[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS BIGINT)}}), recursive := true)
        FROM (SELECT doc_id, {found} AS f, {between} AS b FROM doc)"""


def _tail(z: str) -> str:
    """Probability above the non-negative ``z`` of a standard normal."""
    x = f"(({z}) / sqrt(2.0::DOUBLE))"
    t = f"(1 / (1 + 0.3275911::DOUBLE * {x}))"
    series = (
        f"{t} * (0.254829592::DOUBLE + {t} * (-0.284496736::DOUBLE + {t} * (1.421413741::DOUBLE"
        f" + {t} * (-1.453152027::DOUBLE + {t} * 1.061405429::DOUBLE))))"
    )
    return f"({series} * exp(-{x} * {x}) / 2)"


_ENCODED = " ".join(
    "WHEN "
    + " AND ".join(f"regexp_matches(f, '{x}')" for x in (e.shape, *e.needs))
    + f" THEN {{'e': {i}, 'a': '{e.alphabet}'}}"
    for i, e in enumerate(secrets.ENCODINGS.values())
)
_CHI = "((cbrt((squares * k / n - n) / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))))"
_BOTH = "(2 * ones * (n - ones))"
_RUNS_Z = f"(changes + 1 - ({_BOTH} / n + 1)) / nullif(sqrt({_BOTH} * ({_BOTH} - n) / (n * n * (n - 1))), 0)"
_SECRETS = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT doc_id, 0 AS kind, s, s + length(f) AS e FROM ({_found(_ASSIGN)})
  WHERE length(regexp_extract(f, '{_ASSIGN}', 2)) >= 6
  UNION ALL SELECT doc_id, 1, s, s + length(f) FROM ({_found("AKIA[A-Z0-9]+")}) WHERE length(f) >= 20
  UNION ALL SELECT doc_id, 2, s, s + length(f) FROM ({_found("[0-9a-f]+")}) WHERE length(f) >= 24
), fits AS (
  SELECT doc_id, s, s + length(f) AS e, rtrim(f, '=') AS f, CASE {_ENCODED} END AS c
  FROM ({_found("[A-Za-z0-9+/_-]{20,}={0,6}")})
), parts AS (
  SELECT doc_id, s, e, c.e * 31 + CAST(floor(log2(length(f))) AS INTEGER) AS stratum,
         CAST(length(f) AS DOUBLE) AS n, CAST(length(c.a) AS DOUBLE) AS k,
         CAST(list_sum(list_transform(range(1, length(c.a) + 1),
           lambda i: power(length(f) - length(replace(f, substr(c.a, i, 1), '')), 2))) AS DOUBLE) AS squares,
         translate(f, c.a, repeat('0', length(c.a) // 2) || repeat('1', length(c.a) - length(c.a) // 2)) AS bits,
         list_transform(range(1, length(f) + 1), lambda i: CAST(strpos(c.a, substr(f, i, 1)) AS DOUBLE)) AS x
  FROM fits WHERE c IS NOT NULL
), moments AS (
  SELECT *, (n - length(replace(bits, '01', ''))) / 2 + (n - length(replace(bits, '10', ''))) / 2 AS changes,
         n - length(replace(bits, '1', '')) AS ones, list_transform(x, lambda v: v - list_sum(x) / n) AS y
  FROM parts
), scores AS (
  SELECT doc_id, s, e, stratum, {_CHI} AS z,
         abs({_RUNS_Z}) AS z_runs,
         abs((list_sum(list_transform(range(1, len(y)), lambda i: y[i] * y[i + 1]))
              / nullif(list_sum(list_transform(y, lambda v: v * v)), 0) + 1 / n) * sqrt(n)) AS z_serial
  FROM moments
), tested AS (
  SELECT doc_id, s, e, stratum, least(1, 3 * least(
           CASE WHEN z >= 0 THEN {_tail("z")} ELSE 1 - {_tail("-z")} END,
           coalesce(2 * {_tail("z_runs")}, 0), coalesce(2 * {_tail("z_serial")}, 0))) AS p
  FROM scores
), steps AS (
  SELECT stratum, i, count(*) FILTER (p >= i / 50) AS n, 2 * count(*) FILTER (p >= 0.5) / 50 AS even
  FROM tested, (SELECT unnest(range(1, 26)) AS i) GROUP BY stratum, i
), limits AS (SELECT stratum, min(i) / 50 AS p FROM steps WHERE n > 0 AND n - even * (50 - i) <= 0.05 * n GROUP BY stratum),
noise AS (
  SELECT doc_id, 3 AS kind, s, e FROM tested JOIN limits USING (stratum)
  WHERE tested.p >= limits.p AND NOT EXISTS (
    SELECT 1 FROM base WHERE base.doc_id = tested.doc_id AND base.s < tested.e AND tested.s < base.e)
), listed AS (
  SELECT doc_id, kind, s, (['assign', 'access', 'hex', 'noise'])[kind + 1] || ':' || s || ':' || e AS span
  FROM (SELECT * FROM base UNION ALL SELECT * FROM noise)
), summed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
         string_agg(span, ',' ORDER BY s, kind) AS spans
  FROM listed GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN summed USING (doc_id)"""

SQL = {
    "op12_secrets": _SECRETS,
    "op13_importance": _IMPORTANCE,
    "op7_exact_dedup": _EXACT,
    "op3_decontaminate": _DECONTAMINATE,
    "op5_chat_format": _CHAT,
}

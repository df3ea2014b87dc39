"""The text operators as queries over the given tables, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.class_model import score_by_classes
from meterline.llm.common import read_table, ship, written
from meterline.llm.edit_fingerprint import neighbour_likeness
from meterline.llm import importance, merkle
from meterline.llm.host_quality import MEASURES, judge_by_host
from meterline.llm.language import dictionaries, predict_language
from meterline.llm.mixing import mix
from meterline.llm.packing import pack
from meterline.llm.personal_data import find_personal_data, fitted
from meterline.llm.simhash import as_hex, simhash, simhash_classes
from meterline.llm.suffix_dedup import without_repeats
from meterline.llm import toxicity
from meterline.llm.wrapper_induction import extract_text

Query = Callable[[SparkSession, str], DataFrame]


def op1_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_likeness(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    judged = judge_by_host(docs, "text", "source", "doc_id")
    return judged.select("doc_id", *MEASURES, "base_failed", "host_rejected", "kept")


def op3_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), "page_id", "url", "html")


def op4_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_by_classes(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    prints = written(docs.select("doc_id", simhash(F.col("text")).alias("fingerprint")), "simhash")
    classes = simhash_classes(prints, "doc_id", "fingerprint")
    return classes.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op6_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return find_personal_data(docs, fitted(docs, "doc_id", "text"), "doc_id", "text")


def op7_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mix(docs, "source").select("row.*", "copy", "place")


def op9_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fitted(docs, labels, "doc_id", "text", "toxic")
    return toxicity.score_toxicity(docs, model, "doc_id", "text")


def op10_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return predict_language(docs, dictionaries(docs, "doc_id", "text", "lang"), "doc_id", "text")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    target = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return importance.resample(docs, target).drop("n_words")


def op12_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    lengths = F.transform("removed", lambda span: span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(merkle.build(read_table(spark, sf_dir, "documents", *merkle.FIELDS)))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_edit_fingerprints,
        op2_host_quality,
        op3_wrapper_text,
        op4_brown_classes,
        op5_simhash_golay,
        op6_crf_personal_data,
        op7_bounded_packing,
        op8_poisson_mixing,
        op9_toxic_neighbours,
        op10_zstd_language,
        op11_importance_resampling,
        op12_induced_suffixes,
        op13_merkle_manifest,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: The bytes of a BLOB as numbers, and their CRC-32 by the table of its polynomial, which ``crc_table`` makes.
_BYTES = "list_transform(range(1, strlen(hex({blob})) // 2 + 1), lambda i: ('0x' || substr(hex({blob}), (2 * i - 1)::INT, 2))::UBIGINT)"
_CRC_STEP = "xor(c >> 1, (c & 1) * 3988292384)"
CRC_TABLE = f"""
        crc_table AS (
            SELECT list(list_reduce([b::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: {_CRC_STEP}) ORDER BY b) AS crcs
            FROM range(256) AS bytes(b))"""


def crc32_sql(blob: str) -> str:
    """Needs the only row of ``crc_table`` beside the blob."""
    number = _BYTES.format(blob=blob)
    step = "xor(c >> 8, crcs[(xor(c, x) & 255)::INT + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {number}), lambda c, x: {step}), 4294967295::UBIGINT)"


def merkle_sql(most: int = 6) -> str:
    """All proofs as SQL, for sources of up to ``16 ** most`` rows: each level and each fold is a step of its own."""
    fields = ", ".join(
        f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END" for v in merkle.FIELDS
    )
    lowered = fields.replace("text", f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')")
    steps = [
        CRC_TABLE.strip(),
        f"""leaves AS (
            SELECT coalesce('=' || source, '') AS tree, doc_id, sha256(concat({fields})) AS leaf,
                CASE WHEN {crc32_sql("encode(coalesce(doc_id::VARCHAR, ''))")} % 5 = 0 THEN sha256(concat({lowered})) END AS tampered
            FROM documents, crc_table)""",
        """placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
            FROM leaves)""",
        "d0 AS (SELECT tree, pos, n, leaf AS node FROM placed)",
    ]

    def grown(kind: str) -> None:
        for k in range(most):
            steps.append(f"""{kind}{k + 1} AS (
                SELECT tree, pos // 16 AS pos, max((n + 15) // 16) AS n,
                    CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE max(node) END AS node
                FROM {kind}{k} GROUP BY tree, pos // 16)""")
            steps.append(f"""{kind}_beside{k} AS (
                SELECT a.tree, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS lefts,
                    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS rights
                FROM {kind}{k} a JOIN {kind}{k} b ON a.tree = b.tree AND a.pos // 16 = b.pos // 16
                WHERE a.n > 1 GROUP BY a.tree, a.pos)""")

    def folded(kind: str, before: str, tree: str, pos: str) -> str:
        for k in range(most):
            steps.append(f"""{kind}_fold{k} AS (
                SELECT f.* REPLACE (CASE WHEN s.tree IS NULL THEN f.node ELSE sha256(s.lefts || f.node || s.rights) END AS node,
                    CASE WHEN s.tree IS NULL THEN f.proof ELSE f.proof || s.lefts || s.rights END AS proof)
                FROM {before} f LEFT JOIN {kind}_beside{k} s ON s.tree = {tree} AND s.pos = {pos} // {16**k})""")
            before = f"{kind}_fold{k}"
        return before

    grown("d")
    steps.append(f"""s0 AS (
            SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node, tree AS source
            FROM d{most})""")
    grown("s")
    steps.append("""start AS (
            SELECT p.tree, p.pos, s0.pos AS at, s0.node AS subroot, p.doc_id, p.leaf, coalesce(tampered, leaf) AS node, '' AS proof
            FROM placed p JOIN s0 ON s0.source = p.tree)""")
    last = folded("s", folded("d", "start", "f.tree", "f.pos"), "''", "f.at")
    joined = ",\n        ".join(steps)
    return f"""
        WITH {joined}
        SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, f.node AS folded_root, f.node = r.node AS verified
        FROM {last} f, s{most} r"""


_LOWERED = f"translate(coalesce(text, ''), '{merkle.UPPER}', '{merkle.LOWER}')"
_RUNS = """list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]),
                list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))"""
IMPORTANCE_SQL = rf"""
        WITH {CRC_TABLE.strip()},
        texts AS (
            SELECT row_number() OVER () AS rid, *, {_RUNS} AS runs
            FROM (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
        targets AS (
            SELECT {_RUNS} AS runs
            FROM (SELECT regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)),
        own AS (SELECT rid, unnest(runs) AS run FROM texts),
        wanted AS (SELECT unnest(runs) AS run FROM targets),
        hashed AS (
            SELECT run, {crc32_sql("encode(run)")} % 10000 AS bucket
            FROM (SELECT run FROM own UNION SELECT run FROM wanted) AS d(run), crc_table),
        s AS (SELECT bucket, count(*)::DOUBLE AS s FROM own JOIN hashed USING (run) GROUP BY bucket),
        t AS (SELECT bucket, count(*)::DOUBLE AS t FROM wanted JOIN hashed USING (run) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
                / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
            FROM range(10000) AS r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
        weights AS (SELECT rid, sum(gain)::BIGINT AS weight FROM own JOIN hashed USING (run) JOIN gains USING (bucket) GROUP BY rid),
        scored AS (
            SELECT rid, doc_id, len(w) AS n_words, len(runs)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
                    / 4294967296)))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (rid)),
        ranked AS (
            SELECT *, row_number() OVER (ORDER BY n_words < 20, score DESC, doc_id NULLS LAST, n_features) AS place,
                (count(*) FILTER (WHERE n_words >= 20) OVER ()) * 5 // 100 AS drawn
            FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked"""


ORACLE_SQL: dict[str, str] = {
    "op11_importance_resampling": IMPORTANCE_SQL,
    "op13_merkle_manifest": merkle_sql(),
    "op2_host_quality": rf"""
        WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS whole, {_WORDS} AS w FROM documents),
        listed AS (
            SELECT *, list_filter(string_split(whole, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS shingles
            FROM texts),
        placed AS (SELECT rid, unnest(shingles) AS shingle, unnest(range(len(shingles))) AS pos FROM listed),
        found AS (SELECT rid, pos FROM (SELECT *, count(*) OVER (PARTITION BY rid, shingle) AS n FROM placed) WHERE n > 1),
        covered AS (SELECT rid, count(DISTINCT pos + k) AS n FROM found, range(3) AS r(k) GROUP BY rid),
        measured AS (
            SELECT doc_id, source, len(w)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(regexp_replace(whole, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(n, 0)::BIGINT AS n_repeat_words
            FROM listed LEFT JOIN covered USING (rid)),
        judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                base_failed OR 100 * n_symbols > 30 * n_words AS rule_failed FROM measured),
        hosts AS (SELECT source, count(*) AS texts, sum(rule_failed::INT) AS failures FROM judged GROUP BY source),
        prior AS (SELECT avg(failures / texts) AS mean, var_pop(failures / texts) AS variance FROM hosts),
        weighed AS (SELECT mean, CASE WHEN variance > 0 THEN greatest(mean * (1 - mean) / variance - 1, 1) END AS strength FROM prior),
        verdicts AS (
            SELECT source, 100 * coalesce((failures + strength * mean) / (texts + strength), mean) > 50 AS host_rejected
            FROM hosts, weighed)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
            NOT rule_failed AND NOT host_rejected AS kept
        FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
        """,
    "op8_poisson_mixing": """
        WITH RECURSIVE sizes AS (SELECT source, count(*)::DOUBLE AS texts FROM documents GROUP BY source),
        wholes AS (
            SELECT source, sqrt(texts) / (SELECT sum(sqrt(texts)) FROM sizes) * (SELECT sum(texts) FROM sizes) / texts AS whole
            FROM sizes),
        rates AS (SELECT source, greatest(ceil(whole / 700), 1)::BIGINT AS parts, whole / greatest(ceil(whole / 700), 1) AS rate FROM wholes),
        sums AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS most FROM rates
            UNION ALL
            SELECT source, rate, k + 1, term * rate / (k + 1), most + term * rate / (k + 1) FROM sums
            WHERE k < ceil(rate + 9 * sqrt(rate) + 20)),
        tables AS (SELECT source, list(most ORDER BY k) AS mosts FROM sums GROUP BY source),
        digested AS (
            SELECT *, md5(concat(
                CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
                CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
                CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END)) AS digest
            FROM documents),
        named AS (SELECT *, digest || ':' || row_number() OVER (PARTITION BY digest) AS identity FROM digested),
        drawn AS (
            SELECT named.doc_id, named.source, named.text, identity, mosts,
                list_transform(range(1, parts + 1), lambda p: ('0x' || substr(md5(CASE WHEN p = 1 THEN 'mix-1:' || identity
                    ELSE 'mix-1:' || identity || ':' || p || ':part' END), 1, 12))::BIGINT / 281474976710656.0) AS ats
            FROM named JOIN rates ON named.source IS NOT DISTINCT FROM rates.source
            JOIN tables ON named.source IS NOT DISTINCT FROM tables.source),
        counted AS (
            SELECT *, list_sum(list_transform(ats, lambda t: len(list_filter(mosts, lambda m: m <= t))))::BIGINT AS n FROM drawn),
        copies AS (SELECT doc_id, source, text, identity, unnest(range(1, n + 1)) AS copy FROM counted)
        SELECT doc_id, source, text, copy::BIGINT AS copy,
            ('0x' || substr(md5('mix-1:' || identity || ':' || copy || ':place'), 1, 12))::BIGINT / 281474976710656.0 AS place
        FROM copies
        """,
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)

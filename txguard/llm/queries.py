"""The registered corpus queries: each applies one operator, with its defaults, to its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm import (
    bpe, decontam, fim, language, licenses, merkle, minhash, packing, secrets, sentences, urls, vectors, wavelet,
)
from txguard.plans.workspace import new_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a repository per source: 32 to a directory, 32 directories to one; every 32nd is a LICENSE."""
    n = F.col("doc_id")
    upper = F.concat(F.coalesce("source", F.lit("none")), F.lit("/a"), F.floor(n / 1024))
    lower = F.concat(upper, F.lit("/b"), F.floor(n / 32))
    path = F.when(n % 1024 == 0, F.concat(upper, F.lit("/LICENSE"))).when(n % 32 == 0, F.concat(lower, F.lit("/LICENSE")))
    path = path.otherwise(F.concat(lower, F.lit("/"), n, F.lit(".txt")))
    files = _table(spark, sf_dir, "documents").select(n.alias("id"), path.alias("path"), "text")
    return licenses.licenses_of_files(files).withColumnRenamed("id", "doc_id")


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_table(spark, sf_dir, "documents"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentences.repeats(_table(spark, sf_dir, "documents"), shifted=True)
    return found.select(
        "doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        (F.size("removed") > 0).alias("repeats"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judged(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))
    return found.select("page_id", "host", "path", "rule", "verdict", "mined")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "token-shards")
    wavelet.write_shards(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), path)
    return wavelet.read_documents(spark, path)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 is divisible by 7 are presented with n_chars one larger."""
    docs = _table(spark, sf_dir, "documents")
    other = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(other, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    found = merkle.verified(docs, changed={"n_chars": n_chars})
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest("path").alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.transformed(_table(spark, sf_dir, "documents"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.json")
    found = bpe.decoded(bpe.encoded(_table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return found.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_decontamination": op2_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_near_vectors": op4_near_vectors,
    "op5_secrets": op5_secrets,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_url_filter": op7_url_filter,
    "op8_packing": op8_packing,
    "op9_language": op9_language,
    "op10_token_files": op10_token_files,
    "op11_manifest": op11_manifest,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_byte_pairs": op13_byte_pairs,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

_TERMS = f"regexp_extract_all(lower({{}}), '{licenses.TERM}')"
_NOTICES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))

ORACLE = {
    "op3_license_scan": f"""
        WITH notices AS (SELECT * FROM (VALUES {_NOTICES}) AS v(template, license, body)),
        template_terms AS (
            SELECT template, license, term, count(*) AS c
            FROM (SELECT template, license, unnest({_TERMS.format('body')}) AS term FROM notices) GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM documents),
        df AS (
            SELECT term, count(*) AS df
            FROM (SELECT unnest(list_distinct({_TERMS.format('text')})) AS term FROM documents) GROUP BY term),
        idf AS (
            SELECT DISTINCT term, 1 + ln((n + 1.0) / (coalesce(df, 0) + 1)) AS idf
            FROM template_terms CROSS JOIN n LEFT JOIN df USING (term)),
        vectors AS (SELECT template, license, term, c * idf AS v FROM template_terms JOIN idf USING (term)),
        template_sizes AS (SELECT template, sqrt(sum(v * v)) AS size FROM vectors GROUP BY template),
        passages AS (
            SELECT doc_id, unnest(list_distinct(list_concat(string_split(text, chr(10)), string_split(
                regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'), chr(1))))) AS passage
            FROM documents),
        counts AS (
            SELECT passage, term, count(*) AS c
            FROM (SELECT passage, unnest({_TERMS.format('passage')}) AS term FROM (SELECT DISTINCT passage FROM passages))
            GROUP BY ALL),
        sizes AS (
            SELECT passage, sqrt(sum(pow(c * coalesce(idf, 1 + ln(n + 1.0)), 2))) AS size
            FROM counts CROSS JOIN n LEFT JOIN idf USING (term) GROUP BY passage),
        dots AS (
            SELECT passage, template, license, sum(c * idf * v) AS dot
            FROM counts JOIN idf USING (term) JOIN vectors USING (term) GROUP BY ALL),
        scores AS (
            SELECT passage, license, round(dot / (sizes.size * template_sizes.size), 6) AS score
            FROM dots JOIN sizes USING (passage) JOIN template_sizes USING (template)),
        ranked AS (
            SELECT doc_id, license, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) AS r
            FROM passages JOIN scores USING (passage) WHERE score >= 0.8),
        files AS (
            SELECT doc_id, license, score,
                coalesce(source, 'none') || '/a' || doc_id // 1024 || CASE
                    WHEN doc_id % 1024 = 0 THEN '/LICENSE' WHEN doc_id % 32 = 0 THEN '/b' || doc_id // 32 || '/LICENSE'
                    ELSE '/b' || doc_id // 32 || '/' || doc_id || '.txt' END AS path
            FROM documents LEFT JOIN (SELECT doc_id, license, score FROM ranked WHERE r = 1) USING (doc_id)),
        placed AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS dir FROM files),
        given AS (
            SELECT * FROM (
                SELECT dir, license, score, path, row_number() OVER (PARTITION BY dir ORDER BY score DESC, license, path) AS r
                FROM placed WHERE license IS NOT NULL AND path LIKE '%/LICENSE') WHERE r = 1),
        handed AS (
            SELECT p.doc_id, g.license, g.score, g.path,
                row_number() OVER (PARTITION BY p.doc_id ORDER BY length(g.dir) DESC) AS r
            FROM placed p JOIN given g ON p.dir = g.dir OR starts_with(p.dir, g.dir || '/'))
        SELECT p.doc_id, p.path, coalesce(p.license, h.license) AS license, coalesce(p.score, h.score) AS score,
            CASE WHEN p.license IS NOT NULL THEN 'own' WHEN h.license IS NOT NULL THEN 'inherited' END AS origin,
            CASE WHEN p.license IS NOT NULL THEN p.path ELSE h.path END AS origin_path
        FROM placed p LEFT JOIN (SELECT * FROM handed WHERE r = 1) h USING (doc_id)
    """,
    "op2_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        item_windows AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
            FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT n FROM item_windows),
        windows AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
        hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN item_windows USING (n, g)),
        places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(x, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op11_manifest": """
        WITH RECURSIVE rows AS (
            SELECT row_number() OVER (ORDER BY doc_id) AS r, lang, doc_id,
                sha256(concat(
                    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
                    coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
                sha256(concat(
                    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-'),
                    coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-'),
                    coalesce(strlen(text) || ':' || text, '-'))) AS other
            FROM documents),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM rows),
        up AS (
            SELECT lang, 0 AS level, i, n, leaf AS h FROM leaves
            UNION ALL
            SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up
            WHERE n > 1 GROUP BY lang, level, n, i // 2),
        subroots AS (SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS level, i, n, h FROM subroots
            UNION ALL
            SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, n, i // 2),
        steps AS (
            SELECT l.r, u.level, u.i % 2 AS slot, coalesce(s.h, '') AS sibling
            FROM leaves l JOIN up u ON u.lang IS NOT DISTINCT FROM l.lang AND u.i = l.i >> u.level AND u.n > 1
                LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM u.lang AND s.level = u.level AND s.i = xor(u.i, 1)
            UNION ALL
            SELECT l.r, 100 + t.level, t.i % 2, coalesce(s.h, '')
            FROM leaves l JOIN subroots b ON b.lang IS NOT DISTINCT FROM l.lang JOIN top t ON t.i = b.i >> t.level AND t.n > 1
                LEFT JOIN top s ON s.level = t.level AND s.i = xor(t.i, 1)),
        path AS (SELECT r, list({'slot': slot, 'sibling': sibling} ORDER BY level) AS p FROM steps GROUP BY r),
        fold AS (
            SELECT r, 0 AS k, CASE WHEN crc % 7 = 0 THEN other ELSE leaf END AS h
            FROM (
                SELECT *, xor(4294967295::BIGINT, list_reduce(
                    list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
                    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
                        lambda v, bit: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END))) AS crc
                FROM leaves)
            UNION ALL
            SELECT r, k + 1, sha256(CASE WHEN p[k + 1].slot = 0 THEN h || p[k + 1].sibling ELSE p[k + 1].sibling || h END)
            FROM fold JOIN path USING (r) WHERE k < len(p))
        SELECT l.doc_id, l.leaf, b.h AS subroot, t.h AS root,
            sha256(coalesce(array_to_string([x.sibling FOR x IN p], ''), '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
        FROM leaves l JOIN subroots b ON b.lang IS NOT DISTINCT FROM l.lang JOIN top t ON t.n = 1 LEFT JOIN path USING (r)
            JOIN (SELECT r, arg_max(h, k) AS h FROM fold GROUP BY r) f USING (r)
    """,
    "op12_fill_in_middle": """
        WITH units AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        numbers AS (
            SELECT *, len(w) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
                ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM units),
        formed AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
        parts AS (
            SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
                array_to_string(w[b + 1:n], '') AS suffix FROM formed),
        made AS (
            SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS o FROM parts),
        marks AS (SELECT *, strpos(o, '<P>') AS p, strpos(o, '<S>') AS s, strpos(o, '<M>') AS m FROM made)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars, sha256(o) AS output_sha256,
            sha256(CASE form WHEN 'plain' THEN o WHEN 'psm' THEN substr(o, 4, s - 4) || substr(o, m + 3) || substr(o, s + 3, m - s - 3)
                ELSE substr(o, p + 3, m - p - 3) || substr(o, m + 3) || substr(o, 4, p - 4) END) AS restored_sha256
        FROM marks
    """,
}

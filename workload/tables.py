"""Views over the provided tables, in the shapes the jobs expect, and the small control tables.

Control tables are SQL text that both engines read, so a query and its check work on the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.functions.text import strip, tokens
from docweave.plans.export import ControlTables
from docweave.sources.tables import DOCUMENT_COLUMNS, spread

# Date of the tagged records.
RECORD_DATE = "20240101"

LEXICON = """SELECT * FROM (VALUES
 ('the','는/J_','JX'), ('of','이/J_','JKS'), ('de','은/J_','JX'), ('la','도/J_','JX'), ('der','가/J_','JKS'),
 ('and','와/J_','JC'), ('und','과/J_','JC'), ('et','및/MA','MAJ'),
 ('is','is/VV','VV'), ('was','was/VA','VA'), ('die','die/VV','VV'), ('in','in/XSD','XR'),
 ('to','to/EM','EC'), ('that','that/EM','EC'), ('que','que/EM','EC'),
 ('for','for/XR+하/XSV','XR'), ('are','are/NNG+하/XSV','NNG'), ('by','by/NNG+쪽/NNG','NNG'),
 ('with','with/NNP','NNP'), ('from','from/SL','SL'), ('it','it/NFU','NNG'), ('on','on/NFG','NNG'), ('as','as/FL','SL')
) AS t(word, piece, token_type)"""

VERB_DICT = """SELECT * FROM (VALUES
 ('is','긍정'), ('was','부정'), ('is in','긍정2'), ('for하','부정'), ('die','부정2'), ('was in','긍정'),
 ('are하 is','중립'), ('er','긍정'), ('re an','부정'), ('is다','긍정'), ('was다','부정'), ('die다',''),
 ('in하다','긍정2'), ('for하다','부정'), ('nd','긍정')
) AS t(verb, emotion)"""

CATEGORY = """SELECT * FROM (VALUES
 ('er','에르','re','S01'), ('an','안','en','S02'), ('th','트','er nd','S03'), ('a','아','la le','S04'),
 ('he','히','her','S05'), ('es','에스','un es','S06'), ('ti','티','a re','S07')
) AS t(category_eng, category_kor, synonym, subtopic_code)"""

USERS = "SELECT * FROM (VALUES (1,'Y'), (2,'Y'), (3,'N')) AS t(seq, use_yn)"

CODES = """SELECT * FROM (VALUES
 ('CCT001','monitoring'), ('CCT002','statistics'), ('CCT002','counts'), ('CCT003','sentiment'), ('CCT004','factors')
) AS t(type_cd, name)"""

RULES = """SELECT * FROM (VALUES
 (1, 6, 'Y', 'the', 'of', '', '', ''),
 (2, 6, 'Y', 'der', 'die,und', 'nicht', '', 'example.net,m.'),
 (3, 6, 'N', 'la', '', '', '', ''),
 (4, 7, 'Y', 'is', 'that,was', 'the', 'from', 'example.org,#top'),
 (5, 7, 'Y', 'of the', '', 'and', 'worthless,in the', ''),
 (6, 7, 'Y', 'que', 'la,de', 'el', 'para', 'page=2'),
 (7, 8, 'N', 'the', '', '', '', ''),
 (8, 9, 'Y', 'zzzz', 'the', '', '', ''),
 (9, 9, 'Y', '', '', '', '', '')
) AS t(rule_id, dataset_seq, use_yn, keyword, sub_keywords, title_filter_keywords, content_filter_keywords, filter_urls)"""

QUEUE = """SELECT seq, user_seq, type_cd, 1 AS account_seq, CAST(reg_dt AS TIMESTAMP) AS reg_dt, datasets, channel,
 CAST(start_date AS TIMESTAMP) AS start_date, CAST(end_date AS TIMESTAMP) AS end_date, 'N' AS compare_yn,
 CAST(NULL AS INT) AS campaign_seq, status FROM (VALUES
 (1, 1, 'CCT001', '2024-06-01 10:00:00', '6', 'all', NULL, NULL, 'I'),
 (2, 1, 'CCT002', '2024-06-02 10:00:00', '6,7', '1^1,2,3,4,5,6;2^4,5,9', '2024-02-01 00:00:00', '2024-10-30 23:59:59', 'I'),
 (3, 2, 'CCT003', '2024-06-02 11:00:00', NULL, '3^5;4^6,7,8', '2024-01-01 00:00:00', '2024-12-31 23:59:59', 'I'),
 (4, 3, 'CCT001', '2024-06-03 10:00:00', '6', 'all', NULL, NULL, 'I'),
 (5, 1, 'CCT001', '2024-06-03 10:00:00', '6', 'all', NULL, NULL, 'P'),
 (6, 1, 'CCT001', '2024-06-03 10:00:00', '6', 'all', NULL, NULL, 'C'),
 (7, 1, 'CCT004', '2024-06-04 10:00:00', '8', '', NULL, '2024-09-30 23:59:59', 'I'),
 (8, 2, 'CCT009', '2024-06-05 10:00:00', NULL, NULL, '2024-12-10 00:00:00', '2024-12-25 23:59:59', 'I'),
 (9, 2, 'CCT001', '2024-06-05 10:00:00', '9,7', 'all', '2024-01-05 00:00:00', NULL, 'I')
) AS t(seq, user_seq, type_cd, reg_dt, datasets, channel, start_date, end_date, status)"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def control_tables(spark: SparkSession) -> ControlTables:
    queue = small(spark, QUEUE)
    stamps = {name: F.col(name).cast("timestamp_ntz") for name in ("reg_dt", "start_date", "end_date")}
    return ControlTables(queue.withColumns(stamps), small(spark, USERS), small(spark, CODES), small(spark, RULES))


def plain_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and content only."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), F.col("text").alias("content"))
    return spread(docs)


def crawl_doc(spark: SparkSession, sf_dir: str, with_url: bool = True) -> DataFrame:
    docs = spread(load(spark, sf_dir, "documents"))
    if with_url:
        pages = load(spark, sf_dir, "pages").select("page_id", "url")
        docs = docs.join(pages, F.col("doc_id") == F.col("page_id"), "left")
    else:
        docs = docs.withColumn("url", F.lit(None).cast("string"))
    seq = F.col("doc_id")
    depth1 = (
        F.when(F.col("lang") == "en", 1).when(F.col("lang") == "de", 2).when(F.col("lang") == "fr", 3)
        .when(F.col("lang") == "es", 4)
    )
    none = F.lit(None)
    values = {
        "doc_id": seq.cast("string"),
        "doc_datetime": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((seq % 365).cast("int")),
        "doc_writer": F.concat(F.lit("writer"), (seq % 97).cast("string")),
        "doc_url": F.col("url"),
        "doc_title": F.split_part("text", F.lit("\n"), F.lit(1)),
        "doc_content": F.col("text"),
        "user_id": (seq % 97).cast("string"),
        "view_count": F.col("n_chars"),
        "comment_count": (seq % 50).cast("bigint"),
        "like_count": (seq % 7).cast("bigint"),
        "dislike_count": F.lit(0).cast("bigint"),
        "share_count": (seq % 3).cast("bigint"),
        "locations": none.cast("string"),
        "depth1_nm": F.col("lang"),
        "depth1_seq": depth1.cast("int"),
        "depth2_nm": F.col("source"),
        "depth2_seq": F.regexp_extract("source", "[0-9]+", 0).cast("int"),
        "depth3_nm": none.cast("string"),
        "depth3_seq": none.cast("int"),
        "item_grp_nm": none.cast("string"),
        "item_grp_seq": none.cast("int"),
        "item_nm": none.cast("string"),
        "item_seq": none.cast("int"),
    }
    return docs.select(*[values[name].alias(name) for name in DOCUMENT_COLUMNS])


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load(spark, sf_dir, "conversations")).select(
        F.col("conv_id").cast("string").alias("case_id"),
        F.col("turn").cast("string").alias("response_id"),
        F.col("role").alias("answer_id"),
        F.lit("l1").alias("language_id"),
        F.col("text").alias("comment"),
    )


def order_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue as long as the orders table."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    status = F.when(F.col("o_orderstatus") == "O", "I").when(F.col("o_orderstatus") == "P", "P").otherwise("C")
    channel = F.when(key % 4 == 1, "").when(key % 4 == 2, "all").when(key % 4 == 3, "1^2,3;2^4")
    return load(spark, sf_dir, "orders").select(
        key.cast("int").alias("seq"),
        F.col("o_custkey").cast("int").alias("user_seq"),
        F.concat(F.lit("CCT00"), F.substring("o_orderpriority", 1, 1)).alias("type_cd"),
        (key % 10).cast("int").alias("account_seq"),
        day.alias("reg_dt"),
        F.when(key % 5 != 0, F.concat_ws(",", (key % 9).cast("string"), (10 + key % 4).cast("string"))).alias("datasets"),
        channel.alias("channel"),
        F.when(key % 7 != 0, day - F.make_dt_interval(F.lit(30))).alias("start_date"),
        day.alias("end_date"),
        F.lit("N").alias("compare_yn"),
        F.lit(None).cast("int").alias("campaign_seq"),
        status.alias("status"),
    )


def customer_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("seq"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "N").otherwise("Y").alias("use_yn"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("seq"), F.col("event_id").alias("event_no"),
        F.when(kind == "signup", "I").when(kind.isin("click", "view"), "P").otherwise("C").alias("status"),
    )


def tagging_records(tagged: DataFrame) -> DataFrame:
    """Raw records with a tagging payload; some languages give broken, empty or missing results."""
    result = F.concat(F.lit('"result":['), F.to_json(F.struct("kma")), F.lit("]"))
    body = (
        F.when(F.col("lang") == "es", F.lit('"result":[{"kma":'))
        .when(F.col("lang") == "de", F.lit('"result":[]'))
        .when((F.col("lang") == "fr") & F.col("source").endswith("0"), F.lit('"status":"none"'))
        .otherwise(result)
    )
    return tagged.select(F.concat(F.lit(" "), "doc_id", F.lit("\r\n")).alias("DocId"), F.col("text").alias("Content"), body.alias("JSON"))


def matching_records(docs: DataFrame) -> DataFrame:
    """Raw records with a matching payload: each sentence is a result with its first and last word."""
    split = F.transform(F.split("content", "[.]", -1), lambda s: F.struct(strip(s).alias("string"), tokens(s).alias("tokens")))
    listed = F.filter(split, lambda s: F.size(s["tokens"]) > 0)
    results = F.transform(
        listed,
        lambda s, i: F.struct(
            F.struct(s["string"].alias("string")).alias("sentence"),
            F.struct(s["string"].alias("string"), (80 * i - i % 2).alias("begin")).alias("matched_text"),
            F.array(*[F.struct(F.element_at(s["tokens"], place).alias("value")) for place in (1, -1)]).alias("variables"),
        ),
    )
    return docs.select(
        F.col("doc_id").alias("DocId"), F.col("content").alias("Content"),
        F.concat(F.lit('"result":'), F.to_json(results)).alias("JSON"),
    )


def related_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per document: the second and third word of its content."""
    words = tokens(F.col("content"))
    return plain_docs(spark, sf_dir).select(
        "doc_id", F.concat_ws(" ", F.get(words, F.lit(1)), F.get(words, F.lit(2))).alias("term")
    )

"""One query per scalar operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import exprs as X
from tagloom.operators import cosine as C
from tagloom.operators import frames as O
from tagloom.plans import tags as T
from tagloom.plans import views as V
from tagloom.plans.demo_basic import COSINE, vectors
from tagloom.plans.registry import query

FIRST_LINE = "split_part(coalesce(text, ''), chr(10), 1)"


def _first_lines(spark, d):
    return V.table(spark, d, "documents").select("doc_id", F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1)).alias("line"))


def _joined(column, separator=","):
    return F.array_join(column, separator)


@query(f"SELECT doc_id, array_to_string(list_filter(list_transform(string_split({FIRST_LINE}, ' '), lambda x: trim(x)), lambda x: x <> ''), '|') AS tags FROM documents")
def f_splittags(spark, d):
    return _first_lines(spark, d).select("doc_id", _joined(X.split_tags(F.col("line"), " "), "|").alias("tags"))


@query("SELECT event_id, CASE WHEN user_id % 2 = 0 THEN event_type ELSE '' END AS tags FROM events")
def f_nodigit(spark, d):
    tags = F.array(F.col("user_id").cast("string"), F.when(F.col("user_id") % 2 == 0, F.col("event_type")).otherwise(F.lit("7")))
    return V.table(spark, d, "events").select("event_id", _joined(X.drop_digit_tags(tags)).alias("tags"))


WORDS = "list_filter(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+'), lambda x: length(x) >= 2)"


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct({WORDS.format(x=FIRST_LINE)})), ' ') AS tokens FROM documents")
def f_titletok(spark, d):
    return _first_lines(spark, d).select("doc_id", _joined(F.array_sort(X.title_tokens(F.col("line"))), " ").alias("tokens"))


@query(
    f"""
    , tok AS (SELECT item, unnest({WORDS.format(x="p_name")}) AS tag FROM parts UNION SELECT item, lower(p_name) FROM parts),
    lex AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS tag FROM parts WHERE p_size > 10 UNION SELECT DISTINCT lower(p_name) FROM parts WHERE p_size > 10)
    SELECT DISTINCT item, tag FROM tok WHERE tag IN (SELECT tag FROM lex) AND tag NOT IN (SELECT lower(split_part(p_name, ' ', 1)) FROM parts WHERE p_size = 11)
    """
)
def f_querytok(spark, d):
    p = V.parts(spark, d)
    first = F.lower(F.split_part("p_name", F.lit(" "), F.lit(1)))
    large = p.where("p_size > 10")
    lexicon = large.select(first.alias("word"), F.lit("n").alias("kind")).union(large.select(F.lower("p_name"), F.lit("n"))).union(p.select(F.split_part(F.lower("p_name"), F.lit(" "), F.lit(2)), F.lit("v"))).distinct()
    stop = p.where("p_size = 11").select(first.alias("word")).distinct()
    return T.query_tokens(p.select("item", F.col("p_name").alias("query")), lexicon, ("n",), stop)


PHRASES = "list_transform(range(1, greatest(len({w}), 1)), lambda i: {w}[i] || ' ' || {w}[i + 1])"


@query(f", w AS (SELECT doc_id, {WORDS.format(x=FIRST_LINE)} AS w FROM documents) SELECT doc_id, array_to_string(w, ' ') AS words, array_to_string({PHRASES.format(w='w')}, '|') AS phrases, '' AS bigrams FROM w")
def f_tokcompare(spark, d):
    line = F.col("line")
    return _first_lines(spark, d).select("doc_id", _joined(X.word_tokens(line), " ").alias("words"), _joined(X.phrase_tokens(line), "|").alias("phrases"), _joined(X.bigram_tokens(line)).alias("bigrams"))


@query("SELECT item, regexp_replace(regexp_replace(regexp_replace('season 2 ' || p_name || ' 12', '(season \\d+)|(\\d+)$', '', 'g'), '\\s', '', 'g'), '[<> _,()~'';\":`!@#$%^&*+=\\[\\]{}>?/.|-]', '', 'g') AS title FROM parts")
def f_cleantitle(spark, d):
    return V.parts(spark, d).select("item", X.clean_title(F.concat(F.lit("season 2 "), "p_name", F.lit(" 12"))).alias("title"))


@query("SELECT item, try_cast(regexp_extract(p_brand, '\\d+') AS INTEGER) AS n FROM parts")
def f_firstint(spark, d):
    return V.parts(spark, d).select("item", X.first_int(F.col("p_brand")).alias("n"))


@query("SELECT item, CASE WHEN item % 3 = 0 THEN 0 ELSE p_size END::BIGINT AS n FROM parts")
def f_suffixnum(spark, d):
    title = F.concat("p_name", F.when(F.col("item") % 3 == 0, "_x").otherwise(F.concat(F.lit("_"), "p_size")))
    return V.parts(spark, d).select("item", X.suffix_number(title).alias("n"))


@query("SELECT item, lower(trim('  ' || p_brand || ' ')) AS tag FROM parts")
def f_lowertrim(spark, d):
    return V.parts(spark, d).select("item", X.lower_trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("tag"))


@query("SELECT item, p_brand || ' ' || p_type AS text FROM parts")
def f_repltab(spark, d):
    return V.parts(spark, d).select("item", X.replace_tabs(F.concat_ws("\t", "p_brand", "p_type")).alias("text"))


@query("SELECT item, string_agg(tag || '###' || printf('%.4f', weight), ';' ORDER BY weight DESC, tag) AS list FROM merged GROUP BY item")
def f_fmtlist(spark, d):
    return O.postings(V.merged(spark, d), "item", "tag").select("item", X.format_list(F.col("values"), ";", "###").alias("list"))


@query("SELECT item, tag AS id, cast(printf('%.4f', weight) AS DOUBLE) AS weight FROM merged")
def f_parselist(spark, d):
    lists = O.postings(V.merged(spark, d), "item", "tag").select("item", X.format_list(F.col("values"), ";", "###").alias("list"))
    return lists.select("item", F.explode(X.parse_list(F.col("list"))).alias("v")).select("item", "v.*")


@query(
    """
    SELECT item, p_name AS tag, CASE WHEN item % 3 = 1 THEN item END AS tag_id, CASE item % 3 WHEN 0 THEN 'inner' WHEN 1 THEN 'curated' ELSE 'plain' END AS kind FROM parts
    """
)
def f_tagmark(spark, d):
    marked = F.concat("p_name", F.when(F.col("item") % 3 == 0, "_inner").when(F.col("item") % 3 == 1, F.concat(F.lit("##"), "item")).otherwise(""))
    return V.parts(spark, d).select("item", X.parse_tag_mark(marked).alias("v")).select("item", "v.*")


@query("SELECT item, split_part(p_name, ' ', 1) AS tag, item AS tag_id FROM parts")
def f_zipmap(spark, d):
    pairs = X.zip_tags(F.split("p_name", " "), F.array(F.col("item").cast("string"), F.lit("x")))
    return V.parts(spark, d).select("item", F.explode(pairs).alias("v")).select("item", "v.*")


@query("SELECT DISTINCT tag, ('0x' || substr(md5(tag), 1, 15))::BIGINT AS tag_id FROM ch")
def f_hashid(spark, d):
    return V.channels(spark, d).select("tag").distinct().withColumn("tag_id", X.tag_id_hash(F.col("tag")))


@query("SELECT DISTINCT tag, ('0x' || substr(md5(tag), 1, 15))::BIGINT % 16777216 AS slot FROM ch")
def f_hash(spark, d):
    return V.channels(spark, d).select("tag").distinct().withColumn("slot", X.feature_slot(F.col("tag")))


@query("SELECT item, tag, round(2 / (1 + exp(-2.3 * weight)) - 1, 9) AS weight FROM merged")
def f_sigmoid(spark, d):
    return V.merged(spark, d).select("item", "tag", F.round(X.sigmoid(F.col("weight")), 9).alias("weight"))


@query("SELECT item, tag, round(ln(1 + weight), 9) AS weight FROM merged")
def f_log1p(spark, d):
    return V.merged(spark, d).select("item", "tag", F.round(X.log_weight(F.col("weight")), 9).alias("weight"))


@query("SELECT DISTINCT age::INTEGER AS age, round(CASE WHEN age <= 0 THEN 1.0 ELSE least(1.0, pow(age, -0.35)) END, 9) AS decay FROM month")
def f_decay(spark, d):
    return V.month(spark, d).select("age").distinct().withColumn("decay", F.round(X.decay(F.col("age")), 9))


@query("SELECT item, tag, round(weight * p_size, 9) AS weight FROM merged JOIN parts USING (item)")
def f_scale(spark, d):
    lists = V.merged(spark, d).groupBy("item").agg(F.collect_list("weight").alias("weights"), F.collect_list("tag").alias("tags"))
    grown = lists.join(V.parts(spark, d).select("item", "p_size"), "item").withColumn("weights", X.scaled(F.col("weights"), F.col("p_size")))
    pairs = F.zip_with("tags", "weights", lambda t, w: F.struct(t.alias("tag"), F.round(w, 9).alias("weight")))
    return grown.select("item", F.inline(pairs))


@query(COSINE + "SELECT item, other, round(cosine, 9) AS cosine FROM cos WHERE cosine > 0.3")
def f_cosine(spark, d):
    return C.cosine_pairs(*vectors(spark, d), min_cosine=0.3)


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate - INTERVAL 3 DAY, '%Y%m%d') AS earlier, strftime(o_orderdate - INTERVAL 2 DAY, '%Y%m%d') AS second_last,
           date_diff('day', o_orderdate::DATE, DATE '2000-01-01')::INTEGER AS days FROM orders
    """
)
def f_date(spark, d):
    day = F.to_date("o_orderdate")
    return V.table(spark, d, "orders").select("o_orderkey", X.day_string(day, -3).alias("earlier"), X.last_days(day, 5)[1].alias("second_last"), F.datediff(F.lit("2000-01-01").cast("date"), day).alias("days"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE epoch(o_orderdate)::BIGINT END AS epoch FROM orders")
def f_epoch(spark, d):
    text = F.when(F.col("o_orderkey") % 5 == 0, "no time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return V.table(spark, d, "orders").select("o_orderkey", X.epoch_seconds(text).alias("epoch"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events")
def f_b64json(spark, d):
    payload = F.when(F.col("event_id") % 5 == 0, "*broken*").otherwise(F.base64(F.col("props").cast("binary")))
    return V.table(spark, d, "events").select("event_id", X.decoded_json(payload, "k").alias("k"))


@query('SELECT l_orderkey, l_linenumber, item, least(play, 2 * 15.0) AS play FROM plays')
def f_cap(spark, d):
    return V.plays(spark, d).select("l_orderkey", "l_linenumber", "item", X.capped_play(F.col("play"), F.lit(15.0)).alias("play"))


@query("SELECT event_id, round(CASE WHEN value < 1 THEN 0.2 ELSE user_id / value END, 9) AS ratio FROM events")
def f_ratiodef(spark, d):
    return V.table(spark, d, "events").select("event_id", F.round(X.play_ratio(F.col("user_id"), F.col("value")), 9).alias("ratio"))


@query("SELECT collection, item, round(weight, 9) AS weight FROM epw")
def f_epweight(spark, d):
    return V.episode_weights(spark, d).select("collection", "item", F.round("weight", 9).alias("weight"))


@query("SELECT item, '-1' || chr(9) || item || chr(9) || chr(9) || p_brand || chr(9) || chr(9) || chr(9) || p_size || chr(9) AS line FROM parts")
def f_postsv(spark, d):
    return V.parts(spark, d).select("item", X.positional_line({1: F.col("item"), 3: F.col("p_brand"), 6: F.col("p_size")}, 8).alias("line"))


@query(
    """
    SELECT c_custkey, 'guid=' || c_custkey || chr(9) || CASE c_custkey % 3 WHEN 0 THEN 'CAT_S2:' || c_mktsegment WHEN 1 THEN 'TAG:' || c_name
           ELSE 'CAT_S2:' || c_mktsegment || '$TAG:' || c_name END AS line FROM customer
    """
)
def f_profilestr(spark, d):
    cats = F.when(F.col("c_custkey") % 3 != 1, F.col("c_mktsegment"))
    tags = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))
    return V.table(spark, d, "customer").select("c_custkey", X.profile_line(F.col("c_custkey"), cats, tags).alias("line"))

"""The given tables seen as posts.

Each adapter is one SQL text that both engines run: Spark through ``spark.sql`` with
frames for the placeholders, the checking engine as a chain of common table
expressions. Change a text and both sides change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTS = """
select d.doc_id as post_id, cast(d.doc_id % 50 as string) as user_id,
       concat('user_', cast(d.doc_id % 50 as string)) as username,
       concat('reads ', d.lang, ' ', d.source) as description, d.text as text,
       concat('#', d.lang, ';#', d.source, ';#q', cast(d.doc_id % 7 as string)) as hashtags,
       date '2024-09-01' + cast((d.doc_id * d.doc_id) % 61 as int) as date,
       d.lang as city, d.source as state, l.quality as binary_label
from {documents} d left join {labels} l on d.doc_id = l.doc_id
"""

POSTS_DIRTY = """
select post_id, case when post_id % 17 = 0 then null else user_id end as user_id,
       username, description, text, hashtags,
       case when post_id % 13 = 0 then '10/01/2024'
            when post_id % 2 = 0 then concat(cast(date as string), ' 12:30:00')
            else cast(date as string) end as date,
       case when post_id % 19 = 0 then '  ' when post_id % 23 = 0 then null else concat(' ', city) end as city,
       state,
       case when binary_label is null then 'N'
            when post_id % 2 = 0 then concat(cast(binary_label as string), '.0')
            else cast(binary_label as string) end as binary_label
from {posts}
"""

RAW_POSTS = """
select doc_id as post_id,
       concat(text, ' http://ex.org/', cast(doc_id as string), '#frag', cast(doc_id % 3 as string),
              ' #Tag', cast(doc_id % 7 as string), ' #été_1 😀 awwww',
              case when doc_id % 9 = 0 then ' it&#8217;s &eacute;t&eacute; #e\u0301te\u0301_2' else '' end) as text,
       concat('Jo_', cast(doc_id as string), ' 🎉 (', lang, ')') as username,
       concat('reads ', lang, ' & ', source, ' www.ex.org/', cast(doc_id as string), '  daily!') as description,
       lang as Extracted_Location, concat(lang, ', ', source) as location_raw,
       concat(upper(source), '_Tweets_', lang, '.CSV') as file_name
from {documents}
"""

DAMAGED_POSTS = """
select doc_id as post_id,
       concat(text, case doc_id % 12
           when 0 then ' fish &amp;amp; chips &lt;now&gt;'
           when 1 then ' <b>kept &amp; kept</b>'
           when 2 then ' cafÃ© itâ€™s Ã‰tÃ© Â£5 ðŸ˜€'
           when 3 then ' “curly” and ‘single’ ﬁne'
           when 4 then concat(' line', chr(13), chr(10), 'break', chr(13), 'end', chr(7), '.')
           when 5 then ' ＦＵＬＬ　ｗｉｄｔｈ　５'
           when 6 then ' said&nbsp;&quot;so&quot; &#39;n&#39;'
           when 7 then ' it&#8217;s &eacute;t&eacute; &#x27;q&#X27; &nosuch; &amp;rarr; &#0; &#xD800; &'
           when 8 then ' cafe\u0301 E\u0301te\u0301 #e\u0301te\u0301 a\u0308\u0301 x\u0301 \u0438\u0306'
           when 9 then ' Ð¿Ñ€Ð¸Ð²ÐµÑ‚ Îº Ã… Å¡Ä\u008d'
           else '' end) as text
from {documents}
"""

STANCE_POSTS = """
select post_id, user_id, username, description,
       concat(text, case post_id % 12
           when 0 then ' VOTE  BLUE❤️'
           when 1 then ' Trump 2024!'
           when 2 then ' Never Trump, though they say Trump 2024'
           when 3 then ' Kamala has the worst plan'
           when 4 then ' trump is a coward'
           when 5 then ' I am anti-maga'
           when 6 then ' trumpism 2024 and votes'
           else '' end) as text,
       concat(hashtags, case post_id % 5 when 0 then ';#VoteBlue' when 1 then ';#Trump2024x' else '' end) as hashtags,
       date, city, state,
       case when post_id % 2 = 0 then binary_label else null end as binary_label
from {posts}
"""

ANSWERS = """
select doc_id as post_id,
       case doc_id % 9 when 0 then '1' when 1 then ' 0 ' when 2 then 'Risposta: 1' when 3 then 'Answer: 0'
            when 4 then 'neutral' when 5 then '10' when 6 then 'N' when 7 then '"1".'
            else concat(source, ' says n') end as answer
from {documents}
"""

TAG_LISTS = """
select doc_id as post_id,
       concat('[''#', upper(lang), ''', "', source, ' x"];;#, ##;', cast(doc_id % 7 as string), ' #', lang) as hashtags
from {documents}
"""

SCORES = """
select cast(l.quality as double) as label, cast(d.n_chars as double) as score
from {documents} d join {labels} l on d.doc_id = l.doc_id
"""

PREDICTIONS = """
select cast(quality as double) as label, cast(toxic as double) as prediction from {labels}
"""

ASSIGNED = """
select post_id, binary_label, text, cast((post_id * post_id) % 5 as int) as cluster from {posts}
"""

TEXTS = {
    "posts": POSTS,
    "posts_dirty": POSTS_DIRTY,
    "raw_posts": RAW_POSTS,
    "damaged_posts": DAMAGED_POSTS,
    "stance_posts": STANCE_POSTS,
    "answers": ANSWERS,
    "tag_lists": TAG_LISTS,
    "scores": SCORES,
    "predictions": PREDICTIONS,
    "assigned": ASSIGNED,
}
# The given tables that the adapters read; a declared schema saves a look into the files.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter, or one of the given tables, as a DataFrame."""
    if name in TABLES:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    text = TEXTS[name]
    inputs = {x: frame(spark, sf_dir, x) for x in (*TABLES, "posts") if "{" + x + "}" in text}
    return spark.sql(text, **inputs)


def with_clause(*names: str) -> str:
    """The adapters, and those they read, as common table expressions."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name in TABLES or name in parts:
            return
        text = TEXTS[name]
        if "{posts}" in text:
            add("posts")
        parts[name] = text.format(**{x: x for x in (*TABLES, "posts")})

    for name in names:
        add(name)
    return ",\n".join(f"{name} as ({text})" for name, text in parts.items())

"""The same queries as plain SQL over the given tables, for a second engine to run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from opinionlens import constants as K
from opinionlens.fixtures import catalog as C
from opinionlens.fixtures.adapters import with_clause
from opinionlens.functions import text as tx
from opinionlens.operators import clustering
from opinionlens.operators.labeling import PROMPT

WORD_CLASS = r"\p{L}\p{N}_"


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def word_list(words: Iterable[str]) -> str:
    return "(" + ", ".join(text_literal(w) for w in words) + ")"


def case_when(pairs: Iterable[tuple[str, str]], otherwise: str = "null") -> str:
    return "case " + " ".join(f"when {test} then {value}" for test, value in pairs) + f" else {otherwise} end"


def _query(body: str, *adapters: str, extra: Mapping[str, str] | None = None) -> str:
    parts = [with_clause(*adapters)] if adapters else []
    parts += [f"{name} as ({text})" for name, text in (extra or {}).items()]
    return ("with " + ",\n".join(p for p in parts if p) + "\n" if parts else "") + body


# --- expressions --------------------------------------------------------------

SPACE = tx.SPACE_CHARS


def _strip_urls(c: str) -> str:
    return rf"regexp_replace({c}, 'http[^{SPACE}]+|https[^{SPACE}]+|www[^{SPACE}]+', '', 'g')"


def _strip_emojis(c: str) -> str:
    ranges = "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in K.EMOJI_RANGES)
    return f"regexp_replace({c}, '[{ranges}]', '', 'g')"


def _spaces(c: str) -> str:
    return f"trim(regexp_replace({c}, '[{SPACE}]+', ' ', 'g'))"


def _latin(c: str) -> str:
    return rf"regexp_replace({c}, '[^A-Za-z0-9À-ÖØ-öø-ÿ{SPACE}]', '', 'g')"


def _unescaped(c: str) -> str:
    """Character references decoded, segment by segment."""
    names = ", ".join(f"{text_literal(k)}: {text_literal(v)}" for k, v in tx.ENTITIES.items())
    code = (
        "try_cast(case when lower(s[3]) = 'x' then '0x' || s[4:length(s) - 1] else s[3:length(s) - 1] end as bigint)"
    )
    character = f"case when {code} between 1 and 55295 or {code} between 57344 and 1114111 then chr(cast({code} as int)) else chr(65533) end"
    decoded = case_when(
        [
            ("length(s) > 2 and starts_with(s, '&#')", character),
            ("length(s) > 2 and starts_with(s, '&')", f"coalesce(map {{{names}}}[s[2:length(s) - 1]], s)"),
        ],
        "s",
    )
    once = f"regexp_replace({c}, '&(amp;)+', '&', 'g')"
    return f"array_to_string(list_transform(regexp_extract_all({once}, '{tx.ENTITY_SEGMENTS}', 1), lambda s: {decoded}), '')"


def _repair(c: str) -> str:
    unescaped = _unescaped(c)
    b = f"translate(s, {text_literal(tx.CP1252_CHARS)}, {text_literal(tx.C1_CHARS)})"
    tail = [f"(ord(({b})[{i}]) - 128)" for i in range(2, 5)]
    decoded = case_when(
        [
            (
                f"ord(({b})[1]) < 224",
                f"array_to_string([chr((ord(({b})[2 * i + 1]) - 192) * 64 + ord(({b})[2 * i + 2]) - 128) "
                "for i in range(length(s) // 2)], '')",
            ),
            ("length(s) = 3", f"chr((ord(({b})[1]) - 224) * 4096 + {tail[0]} * 64 + {tail[1]})"),
            ("length(s) = 4", f"chr({tail[0]} * 4096 + {tail[1]} * 64 + {tail[2]})"),
        ]
    )
    out = f"case when contains({c}, '<') then {c} else {unescaped} end"
    out = (
        f"array_to_string(list_transform(regexp_extract_all({out}, '{tx.SEGMENT_PATTERN}', 1), "
        f"lambda s: case when regexp_full_match(s, '{tx.MOJIBAKE_PATTERN}') then {decoded} else s end), '')"
    )
    out = f"translate({out}, {text_literal(tx.REPAIR_FROM)}, {text_literal(tx.REPAIR_TO)})"
    for old, new in tx.LIGATURES.items():
        out = f"replace({out}, {text_literal(old)}, {text_literal(new)})"
    for line_break in ("chr(13) || chr(10)", "chr(13)", "chr(8232)", "chr(8233)"):
        out = f"replace({out}, {line_break}, chr(10))"
    controls = tx.CONTROL_PATTERN[tx.CONTROL_PATTERN.index(")") + 1 :]
    return f"nfc_normalize(regexp_replace({out}, '{controls}', '', 'g'))"


def _clean_text(c: str) -> str:
    return _spaces(_strip_emojis(_strip_urls(_repair(c))))


def _names(keywords: Sequence[str]) -> str:
    return (
        "cast(regexp_matches(lower(concat_ws(' ', text, hashtags)), "
        f"'(^|[^{WORD_CLASS}])({'|'.join(keywords)})($|[^{WORD_CLASS}])') as int)"
    )


def _rule(
    text: str = "text",
    tags: str = "hashtags",
    neg_patterns: Sequence[str] = K.NEG_PATTERNS,
    pos_patterns: Sequence[str] = K.POS_PATTERNS,
) -> str:
    content = f"lower({text} || ' ' || {tags})"
    return case_when(
        [
            (f"regexp_matches({content}, '{'|'.join(patterns)}')", value)
            for patterns, value in ((neg_patterns, "0"), (pos_patterns, "1"))
        ]
    )


def _prompt(text: str, tags: str) -> str:
    before, rest = PROMPT.split("{text}")
    middle, after = rest.split("{hashtags}")
    shown = f"case when {tags} = '' then {text_literal(K.NO_TAGS_WORD)} else {tags} end"
    return f"{text_literal(before)} || {text} || {text_literal(middle)} || {shown} || {text_literal(after)}"


def _answer(c: str) -> str:
    found = f"regexp_extract(upper(trim({c})), '(^|[^0-9A-Z])([01N])($|[^0-9A-Z])', 2)"
    return f"case {found} when '1' then 1 when '0' then 0 end"


def _share(part: str, whole: str) -> str:
    return f"round({part} / {whole}, 4)"


def _side(pos: str, neg: str) -> str:
    return f"case when {pos} > {neg} then 'POS' when {neg} > {pos} then 'NEG' else 'BALANCED' end"


def _place(c: str) -> str:
    return f"case when trim(coalesce({c}, '')) = '' then 'Unknown' else trim({c}) end"


CLASS_COUNTS = """count(*) filter (where binary_label = 1) as pos,
       count(*) filter (where binary_label = 0) as neg,
       count(*) filter (where binary_label is null) as unclear"""

# --- common table expressions -------------------------------------------------

CLEAN = f"""
select post_id, user_id, username, coalesce(description, '') as description, coalesce(text, '') as text,
       coalesce(hashtags, '') as hashtags, try_cast(date as date) as date,
       {_place('city')} as city, {_place('state')} as state,
       try_cast(try_cast(binary_label as double) as int) as binary_label
from posts_dirty"""

GEO = """
select state, city, count(*) as tweet_count, count(distinct user_id) as unique_users
from clean group by state, city"""

TEMPORAL = f"""
select date, state, count(*) as tweet_count, {CLASS_COUNTS}
from clean group by date, state"""

TAG_PIECES = r"""
select post_id, binary_label, trim(unnest(regexp_split_to_array(
           regexp_replace(lower(hashtags), '[\[\]''"{}]', ' ', 'g'), '[,;\s]+'))) as piece
from posts"""

TAG_ROWS = """
select post_id, binary_label, case when starts_with(piece, '#') then piece else '#' || piece end as hashtag
from tag_pieces where length(piece) > 1"""

DISTINCTIVE = f"""
select *, abs(orientation_score) as distinctiveness_score,
       {_side('orientation_score', '0')} as dominant_orientation
from (
    select hashtag, total_count, pos_count, neg_count,
           {_share('pos_count', 'total_count')} as pos_share, {_share('neg_count', 'total_count')} as neg_share,
           {_share('(pos_count - neg_count)', 'total_count')} as orientation_score
    from (
        select hashtag, count(*) as total_count, count(*) filter (where binary_label = 1) as pos_count,
               count(*) filter (where binary_label = 0) as neg_count
        from tag_rows where binary_label in (0, 1) group by hashtag having count(*) >= {K.MIN_TAG_COUNT}
    )
)
order by distinctiveness_score desc, total_count desc, hashtag limit {K.TOP_N}"""

USERS = f"""
select *, {_side('pos_tweets', 'neg_tweets')} as user_orientation
from (
    select state, city, user_id, count(*) as classified_tweets,
           count(*) filter (where binary_label = 1) as pos_tweets,
           count(*) filter (where binary_label = 0) as neg_tweets
    from clean where binary_label in (0, 1) and user_id is not null group by state, city, user_id
)"""

CITIES = f"""
select *, {_share('pos_users', 'classified_users')} as pos_user_share,
       {_share('neg_users', 'classified_users')} as neg_user_share,
       {_share('balanced_users', 'classified_users')} as balanced_user_share,
       {_share('abs(pos_users - neg_users)', 'classified_users')} as user_polarization_score,
       {_side('pos_users', 'neg_users')} as dominant_user_orientation
from (
    select state, city, count(*) as classified_users,
           count(*) filter (where user_orientation = 'POS') as pos_users,
           count(*) filter (where user_orientation = 'NEG') as neg_users,
           count(*) filter (where user_orientation = 'BALANCED') as balanced_users,
           cast(sum(classified_tweets) as bigint) as classified_tweets,
           cast(sum(pos_tweets) as bigint) as pos_tweets, cast(sum(neg_tweets) as bigint) as neg_tweets
    from users group by state, city having count(*) >= {K.MIN_CITY_USERS}
)"""

STATE_POLARIZATION = """
select *, coalesce(abs(pos_users - neg_users) / nullif(classified_users, 0), 0.0) as user_polarization_score
from (
    select state, cast(sum(classified_users) as bigint) as classified_users,
           cast(sum(pos_users) as bigint) as pos_users, cast(sum(neg_users) as bigint) as neg_users,
           cast(sum(balanced_users) as bigint) as balanced_users
    from cities group by state
)"""

COMPARISON = f"""
select state, tweet_count, a_mentions, b_mentions, only_a, only_b, "both",
       {_share('a_mentions', 'tweet_count')} as a_share, {_share('b_mentions', 'tweet_count')} as b_share
from (
    select state, count(*) as tweet_count, count(*) filter (where a = 1) as a_mentions,
           count(*) filter (where b = 1) as b_mentions, count(*) filter (where a = 1 and b = 0) as only_a,
           count(*) filter (where a = 0 and b = 1) as only_b, count(*) filter (where a = 1 and b = 1) as "both"
    from (select state, {_names(C.KEYWORDS_A)} as a, {_names(C.KEYWORDS_B)} as b from posts)
    group by state
)"""


def _clean_query(body: str, *names: str) -> str:
    """A query over normalised posts and the named expressions built on them."""
    texts = {
        "clean": CLEAN, "geo": GEO, "temporal": TEMPORAL, "users": USERS, "cities": CITIES,
        "states": STATE_POLARIZATION, "comparison": COMPARISON,
    }
    return _query(body, "posts_dirty", extra={n: texts[n] for n in ("clean", *names)})


def _tag_query(body: str, adapter: str = "posts", **extra: str) -> str:
    pieces = TAG_PIECES
    if adapter != "posts":
        pieces = pieces.replace("binary_label", "null as binary_label").replace("from posts", f"from {adapter}")
    return _query(body, adapter, extra={"tag_pieces": pieces, "tag_rows": TAG_ROWS, **extra})


def _registry_query(more: str = "") -> str:
    """Rows of each result that the runner writes."""
    texts = {
        "clean": CLEAN, "geo": GEO, "temporal": TEMPORAL, "users": USERS, "cities": CITIES, "comparison": COMPARISON,
        "tag_pieces": TAG_PIECES, "tag_rows": TAG_ROWS, "distinctive": DISTINCTIVE,
        "counted": f"select hashtag, count(*) from tag_rows group by hashtag limit {K.TOP_N}",
    }
    # The runner is given the normalised posts, and so are the tags here.
    texts["tag_pieces"] = texts["tag_pieces"].replace("from posts", "from clean")
    texts["comparison"] = texts["comparison"].replace("from posts", "from clean")
    names = {
        "geo_distribution": "geo", "temporal_evolution": "temporal", "top_hashtags": "counted",
        "distinctive_hashtags": "distinctive", "keyword_comparison": "comparison", "polarization_city": "cities",
    }
    body = " union all ".join(f"select '{n}' as result, count(*) as \"rows\" from {t}" for n, t in names.items()) + more
    return _query(body, "posts_dirty", extra=texts)


def _asked() -> str:
    """Posts with what the rules and the stand-in for a model say."""
    return f"""
select post_id, binary_label, rule,
       case length({_prompt('text', 'hashtags')}) % 4 when 0 then 1 when 1 then 0 end as model
from (select *, {_rule()} as rule from stance_posts)"""


def _label_query(decided_by_model: bool) -> str:
    if not decided_by_model:
        return _query(
            "select post_id, coalesce(binary_label, rule) as binary_label, "
            "case when binary_label is not null then 'kept' when rule is not null then 'rule' else 'pending' end "
            f"as label_status from (select *, {_rule()} as rule from stance_posts)",
            "stance_posts",
        )
    return _query(
        "select post_id, coalesce(binary_label, rule, model) as binary_label, "
        "case when binary_label is not null then 'kept' when rule is not null then 'rule' "
        "when model is not null then 'model' else 'neutral' end as label_status from asked",
        "stance_posts",
        extra={"asked": _asked()},
    )


def _kmeans(terms: str, steps: int) -> dict[str, str]:
    """Tables of K-Means in whole numbers: vectors ``entries``, and for each step ``near`` and ``means``."""
    parts = {
        "terms": terms,
        "entries": "select post_id, word, cast(round(tf * idf / sqrt(sum((tf * idf) ** 2) over (partition by post_id)) "
        f"* {clustering.SCALE}) as bigint) as q "
        "from (select post_id, word, count(*) as tf from kept_words group by post_id, word) join terms using (word)",
        "clusters": f"select unnest(range({C.GIVEN_CENTROIDS})) as cluster",
        "means0": f"select post_id as cluster, word, q as weight from entries where post_id < {C.GIVEN_CENTROIDS}",
    }
    for k in range(steps + 1):
        parts[f"dots{k}"] = f"select e.post_id, m.cluster, sum(e.q * m.weight) as dot from entries e join means{k} m using (word) group by 1, 2"
        parts[f"sizes{k}"] = f"select cluster, coalesce(sum(weight * weight), 0) as size from clusters left join means{k} using (cluster) group by cluster"
        parts[f"near{k}"] = (
            f"select post_id, arg_min(cluster, (size - 2 * coalesce(dot, 0), cluster)) as cluster from posts cross join sizes{k} "
            f"left join dots{k} using (post_id, cluster) group by post_id"
        )
        parts[f"means{k + 1}"] = (
            f"select cluster, word, cast(sum(q) // posts as bigint) as weight, posts from near{k} join entries using (post_id) "
            f"join (select cluster, count(*) as posts from near{k} group by cluster) using (cluster) group by cluster, word, posts"
        )
    return parts


def _buckets(size: int) -> str:
    """The signed buckets of ``kept_words``, as ``post_id``, ``bucket`` and ``value``."""
    return (
        f"select post_id, cast(('0x' || substr(md5(word), 1, 7))::bigint % {size} as int) as bucket, "
        "cast(sum(case when substr(md5(word), 8, 1) < '8' then 1 else -1 end) as bigint) as value "
        "from kept_words join posts using (post_id) where binary_label in (0, 1) group by 1, 2 having value <> 0"
    )


def oracles() -> dict[str, str]:
    stops = word_list(sorted({w.lower() for w in [*K.ENGLISH_STOPWORDS, *K.EXTRA_STOPWORDS]}))
    post_words = "select post_id, state, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from posts"
    kept_words = f"select * from post_words where word not in {stops}"
    word_ctes = {"post_words": post_words, "kept_words": kept_words}
    top_words = (
        "select word, count(*) as count from kept_words group by word "
        f"order by count(*) desc, word limit {K.COOCCURRENCE_WORDS}"
    )
    split_at = "cast(('0x' || substr(md5(cast(post_id as varchar)), 1, 8)) as bigint) % 100"
    raw_ctes = {
        "repaired": f"select * exclude (text), {_repair('text')} as text from raw_posts",
        "split_tags": (
            f"select * exclude (text), array_to_string(regexp_extract_all(text, '#[{WORD_CLASS}]+'), ';') as hashtags, "
            f"regexp_replace(text, '#[{WORD_CLASS}]+', '', 'g') as text from repaired"
        ),
        "done": f"select * exclude (text), {_clean_text('text')} as text from split_tags",
    }
    state_of_file = case_when(
        (f"contains(lower(file_name), {text_literal(k)})", text_literal(s)) for k, s in C.FILE_KEYS.items()
    )
    state_code = case_when((f"state = {text_literal(s)}", text_literal(c)) for s, c in C.STATE_CODES.items())
    states = word_list(C.STATES)
    summary = (
        f"select *, {_share('pos', 'tweet_count')} as pos_share, {_share('neg', 'tweet_count')} as neg_share "
        f"from (select cluster, count(*) as tweet_count, {CLASS_COUNTS} from assigned group by cluster)"
    )
    cluster_words = {
        "post_words": "select cluster, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from assigned",
        "kept_words": kept_words,
        "terms": "select cluster, word, count, cast(rank as int) as rank from (select *, row_number() over "
        "(partition by cluster order by count desc, word) as rank from "
        "(select cluster, word, count(*) as count from kept_words group by cluster, word)) "
        f"where rank <= {K.TERMS_PER_CLUSTER}",
    }
    users_once = "count(distinct user_id) as unique_users"
    by_city_sum = "cast(sum(unique_users) as bigint)"

    terms = (
        "select word, ln((n + 1) / (doc_count + 1)) as idf from (select word, count(*) as term_count, "
        "count(distinct post_id) as doc_count, (select count(*) from posts) as n from kept_words group by word) "
        f"where doc_count >= {K.MIN_DF} and doc_count <= {K.MAX_DF} * n "
        f"order by term_count desc, word limit {K.VOCAB_SIZE}"
    )
    return {
        "geo_distribution": _clean_query("select * from geo", "geo"),
        "temporal_evolution": _clean_query("select * from temporal", "temporal"),
        "overview_kpis": _clean_query(
            f"select count(*) as tweet_count, (select {by_city_sum} from geo) as unique_users_by_city_sum, "
            f"{users_once}, (select count(*) from geo) as active_cities from clean",
            "geo",
        ),
        "state_volume": _clean_query(
            f"select * from (select state, count(*) as tweet_count, any_value(by_city) as unique_users_by_city_sum, "
            f"{users_once}, {state_code} as state_code from clean "
            f"join (select state as s, {by_city_sum} as by_city from geo group by state) on s = state "
            "group by state) where state_code is not null",
            "geo",
        ),
        "top_state": _clean_query(
            "select state, cast(sum(tweet_count) as bigint) as tweet_count from geo group by state "
            "order by 2 desc, 1 limit 1",
            "geo",
        ),
        "geo_rollup": _clean_query(
            "select state, city, cast(grouping(state, city) as bigint) as level, "
            f"cast(sum(tweet_count) as bigint) as tweet_count, {by_city_sum} as unique_users_by_city_sum "
            "from geo group by rollup (state, city)",
            "geo",
        ),
        "city_ranking": _clean_query(
            "select *, city || ', ' || state as area from geo order by tweet_count desc, state, city limit 12", "geo"
        ),
        "city_ranking_by_users": _clean_query(
            "select *, city || ', ' || state as area from geo order by unique_users desc, state, city limit 15", "geo"
        ),
        "state_users_exact": _clean_query("select state, count(distinct user_id) as unique_users from clean group by state having count(user_id) > 0"),
        "daily_volume": _clean_query("select date, count(*) as tweet_count from clean group by date"),
        "daily_state_volume": _clean_query("select date, state, count(*) as tweet_count from clean group by all"),
        "daily_composition": _clean_query(f"select date, {CLASS_COUNTS} from clean group by date"),
        "run_registry": _registry_query(),
        "write_report": _registry_query(" union all select 'after a failed run', count(*) from geo"),
        "available_results": _clean_query("select unnest(['geo_distribution', 'temporal_evolution']) as result"),
        "score_metrics_given": _query(
            "select 'accuracy' as metric, round(count(*) filter (where label = prediction) / count(*), 9) as value "
            "from predictions",
            "predictions",
        ),
        "tfidf_vectors": _query(
            "select post_id, word, round(tf * idf / sqrt(sum((tf * idf) ** 2) over (partition by post_id)), 9) as weight "
            "from (select post_id, word, count(*) as tf from kept_words group by post_id, word) join terms using (word)",
            "posts",
            extra={
                **word_ctes,
                "terms": terms,
            },
        ),
        "kmeans_step_given": _query("select cluster, word, weight, posts from means1", "posts", extra={**word_ctes, **_kmeans(terms, 0)}),
        "kmeans_assigned_given": _query(
            f"select post_id, cast(cluster as int) as cluster from near{C.GIVEN_STEPS}", "posts", extra={**word_ctes, **_kmeans(terms, C.GIVEN_STEPS)}
        ),
        "hashed_terms": _query(_buckets(K.SVM_HASH_SIZE), "posts", extra=word_ctes),
        "hinge_gradient_given": _query(
            "select bucket, round(cast(sum(-side * value) as double), 6) as gradient from within join entries using (post_id) group by bucket "
            f"union all select {C.GIVEN_BUCKETS}, coalesce(sum(-side), 0)::double from within "
            f"union all select {C.GIVEN_BUCKETS} + 1, round(coalesce(sum(short), 0), 6) from within",
            "posts",
            extra={
                **word_ctes,
                "entries": _buckets(C.GIVEN_BUCKETS),
                "scores": "select post_id, sum(value * ((bucket * 37) % 101 - 50) / 1000.0::double) as score from entries group by post_id",
                "sides": "select post_id, 2 * binary_label - 1 as side from posts where binary_label in (0, 1)",
                "within": f"select post_id, side, 1 - side * (coalesce(score, 0) + {C.GIVEN_INTERCEPT}::double) as short "
                "from sides left join scores using (post_id) where short > 0",
            },
        ),
        "distinct_states": _clean_query("select distinct state from clean"),
        "filter_states": _clean_query(f"select * from geo where state in {states}", "geo"),
        "formatted_volume": _clean_query(
            "select date, replace(format('{:,}', count(*) * 12345), ',', '.') as shown from clean group by date"
        ),
        "top_hashtags": _tag_query(
            "select hashtag, count(*) as count from tag_rows group by hashtag "
            f"order by count(*) desc, hashtag limit {K.TOP_N}"
        ),
        "distinctive_hashtags": _tag_query("select * from distinctive", distinctive=DISTINCTIVE),
        "tag_extremes": _tag_query(
            "(select * from distinctive where orientation_score < 0 "
            "order by orientation_score, total_count desc, hashtag limit 15) union all "
            "(select * from distinctive where orientation_score > 0 "
            "order by orientation_score desc, total_count desc, hashtag limit 15)",
            distinctive=DISTINCTIVE,
        ),
        "frequent_words": _query(
            "select word, count(*) as count from kept_words group by word "
            f"order by count(*) desc, word limit {K.TOP_N}",
            "posts",
            extra=word_ctes,
        ),
        "word_cooccurrence": _query(
            "select a.word as word_a, b.word as word_b, count(*) as count from present a join present b "
            "on a.post_id = b.post_id and a.word < b.word group by 1, 2 "
            f"order by count(*) desc, 1, 2 limit {K.COOCCURRENCE_PAIRS}",
            "posts",
            extra={
                **word_ctes,
                "top_words": top_words,
                "present": "select distinct post_id, word from kept_words where word in (select word from top_words)",
            },
        ),
        "group_top_terms": _query(
            "select state, word, count, cast(rank as int) as rank from (select *, row_number() over "
            "(partition by state order by count desc, word) as rank from "
            "(select state, word, count(*) as count from kept_words group by state, word)) "
            f"where rank <= {K.TERMS_PER_CLUSTER}",
            "posts",
            extra=word_ctes,
        ),
        "tfidf_terms": _query(
            "select word, term_count, doc_count, round(ln((n + 1) / (doc_count + 1)), 9) as idf from "
            "(select word, count(*) as term_count, count(distinct post_id) as doc_count, "
            "(select count(*) from posts) as n from kept_words group by word) "
            f"where doc_count >= {K.MIN_DF} and doc_count <= {K.MAX_DF} * n "
            f"order by term_count desc, word limit {K.VOCAB_SIZE}",
            "posts",
            extra=word_ctes,
        ),
        "keyword_flags": _query(
            f"select post_id, {_names(C.KEYWORDS_A)} as mentions_a, {_names(C.KEYWORDS_B)} as mentions_b from posts",
            "posts",
        ),
        "keyword_comparison": _clean_query("select * from comparison", "comparison"),
        "state_mentions": _clean_query("select state, a_mentions, b_mentions from comparison", "comparison"),
        "user_orientation": _clean_query("select * from users", "users"),
        "polarization_city": _clean_query("select * from cities", "users", "cities"),
        "polarization_state": _clean_query("select * from states", "users", "cities", "states"),
        "polarization_unpivot": _clean_query(
            " union all ".join(
                f"select state, '{c}' as orientation, {c} as users from states"
                for c in ("pos_users", "neg_users", "balanced_users")
            ),
            "users", "cities", "states",
        ),
        "polarized_cities": _clean_query(
            "select *, city || ', ' || state as area from cities where classified_users >= 3 "
            "order by user_polarization_score desc, classified_users desc, state, city limit 25",
            "users", "cities",
        ),
        "label_bounds": _clean_query(
            "select max(classified_users) as max_classified_users, max(user_polarization_score) as max_score from cities",
            "users", "cities",
        ),
        "state_from_source": _query(f"select post_id, file_name, {state_of_file} as state from raw_posts", "raw_posts"),
        "strip_emojis": _query(f"select post_id, {_strip_emojis('text')} as text from raw_posts", "raw_posts"),
        "strip_urls": _query(f"select post_id, {_strip_urls('text')} as text from raw_posts", "raw_posts"),
        "normalize_spaces": _query(f"select post_id, {_spaces('text')} as text from raw_posts", "raw_posts"),
        "extract_tags_raw": _query(
            f"select post_id, array_to_string(regexp_extract_all(text, '#[{WORD_CLASS}]+'), ';') as tags from raw_posts",
            "raw_posts",
        ),
        "repair_text": _query(f"select post_id, {_repair('text')} as text from damaged_posts", "damaged_posts"),
        "undo_misreading": _query("select post_id, text from posts", "posts"),
        "clean_text": _query(f"select post_id, {_clean_text('text')} as text from damaged_posts", "damaged_posts"),
        "clean_description": _query(
            f"select post_id, {_latin(_clean_text('description'))} as description from raw_posts", "raw_posts"
        ),
        "clean_username": _query(
            f"select post_id, {_spaces(_latin(_clean_text('username')))} as username from raw_posts", "raw_posts"
        ),
        "clean_folder": _query(
            f"select post_id, text, hashtags, {_spaces(_latin(_clean_text('username')))} as username, "
            f"{_latin(_clean_text('description'))} as description, Extracted_Location as city from done where trim(text) <> ''",
            "raw_posts",
            extra=raw_ctes,
        ),
        "clean_posts": _query(
            f"select post_id, text, hashtags, {_spaces(_latin(_clean_text('username')))} as username, "
            f"{_latin(_clean_text('description'))} as description, Extracted_Location as city, "
            f"{state_of_file} as state from done where trim(text) <> ''",
            "raw_posts",
            extra=raw_ctes,
        ),
        "posts_normalized": _clean_query("select * from clean"),
        "parse_tags": _tag_query("select post_id, hashtag from tag_rows", "tag_lists"),
        "tokens": _query(
            "select post_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[a-z]{3,}'), "
            f"lambda w: w not in {stops}), ' ') as words from posts",
            "posts",
        ),
        "rule_label": _query(f"select post_id, {_rule()} as rule_label from stance_posts", "stance_posts"),
        "rule_label_custom": _query(
            f"select post_id, {_rule(neg_patterns=C.CUSTOM_NEG, pos_patterns=C.CUSTOM_POS)} as rule_label from stance_posts",
            "stance_posts",
        ),
        "build_prompt": _query(
            f"select post_id, {_prompt('text', 'tags')} as prompt from "
            "(select *, case when post_id % 3 = 0 then '' else hashtags end as tags from stance_posts)",
            "stance_posts",
        ),
        "parse_answer": _query(f"select post_id, {_answer('answer')} as label from answers", "answers"),
        "label_posts": _label_query(decided_by_model=False),
        "model_label": _label_query(decided_by_model=True),
        "model_label_overlapped": _label_query(decided_by_model=True),
        "label_resume": _label_query(decided_by_model=True),
        "label_retry": _label_query(decided_by_model=True),
        "label_relabel": _query(
            "select post_id, case when post_id % 2 = 0 then coalesce(rule, model) else coalesce(binary_label, rule) end as binary_label, "
            "case when post_id % 2 = 0 then case when rule is not null then 'rule' when model is not null then 'model' else 'neutral' end "
            "when binary_label is not null then 'kept' when rule is not null then 'rule' else 'pending' end as label_status from asked",
            "stance_posts",
            extra={"asked": _asked()},
        ),
        "still_to_label": _query(
            f"select post_id from (select *, {_rule()} as rule from stance_posts) "
            "where post_id % 3 = 0 or (binary_label is null and rule is null)",
            "stance_posts",
        ),
        "label_coverage": _clean_query(
            "select state, count(*) as total_posts, count(binary_label) as labelled_posts from clean group by state"
        ),
        "read_posts": _clean_query("select * from clean"),
        "stored_posts": _clean_query(
            "select state, user_id, date, binary_label, text from clean "
            f"where binary_label in (0, 1) and state in {states}"
        ),
        "stored_results": _clean_query(f"select *, {state_code} as state_code from temporal", "temporal"),
        "cluster_summary_given": _query("select * from summary", "assigned", extra={"summary": summary}),
        "cluster_shares_given": _query(
            " union all ".join(
                f"select cluster, tweet_count, '{c}_share' as orientation, {c} / tweet_count as share from summary"
                for c in ("pos", "neg", "unclear")
            ),
            "assigned",
            extra={"summary": summary},
        ),
        "cluster_terms_given": _query("select * from terms", "assigned", extra=cluster_words),
        "terms_of_cluster_given": _query("select * from terms where cluster = 1", "assigned", extra=cluster_words),
        "confusion_matrix_given": _query(
            "select label, prediction, count(*) as count from predictions group by label, prediction", "predictions"
        ),
        "label_pivot": _query(
            "select label, count(*) filter (where prediction = 0) as predicted_0, "
            "count(*) filter (where prediction = 1) as predicted_1 from predictions group by label",
            "predictions",
        ),
        "hash_split": _query(
            f"select post_id, case when {split_at} < {K.TRAIN_PERCENT} then 'train' else 'test' end as part from posts",
            "posts",
        ),
        "auc_from_scores": _query(
            "select 'area_under_roc' as metric, round((sum(place) filter (where label = 1) "
            "- count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2) "
            "/ (count(*) filter (where label = 1) * count(*) filter (where label = 0)), 9) as value "
            "from (select label, rank() over (order by score) "
            "+ (count(*) over (partition by score) - 1) / 2 as place from scores)",
            "scores",
        ),
        "roc_area": _query(
            "select 'area_under_roc' as metric, round((sum(place) filter (where label = 1) "
            "- count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2) "
            "/ (count(*) filter (where label = 1) * count(*) filter (where label = 0)), 9) as value "
            "from (select label, rank() over (order by score) "
            "+ (count(*) over (partition by score) - 1) / 2 as place from scores)",
            "scores",
        ),
        "classification_metrics": _query(
            "select 'accuracy' as metric, round((t0 + t1) / n, 9) as value from parts union all "
            "select 'f1', round(a0 / n * (2 * t0 / (a0 + p0)) + a1 / n * (2 * t1 / (a1 + p1)), 9) from parts union all "
            "select 'weighted_precision', round(a0 / n * coalesce(t0 / nullif(p0, 0), 0) "
            "+ a1 / n * coalesce(t1 / nullif(p1, 0), 0), 9) from parts union all "
            "select 'weighted_recall', round(a0 / n * (t0 / a0) + a1 / n * (t1 / a1), 9) from parts",
            "predictions",
            extra={
                "parts": "select count(*) as n, count(*) filter (where label = 0) as a0, "
                "count(*) filter (where label = 1) as a1, count(*) filter (where prediction = 0) as p0, "
                "count(*) filter (where prediction = 1) as p1, "
                "count(*) filter (where label = 0 and prediction = 0) as t0, "
                "count(*) filter (where label = 1 and prediction = 1) as t1 from predictions"
            },
        ),
    }

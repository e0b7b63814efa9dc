"""The domain tables once more as ANSI SQL, for value checks of the registered queries."""

from __future__ import annotations

from larder import constants as K
from larder.plans import settings as S


def rnd(expr: str, places: int) -> str:
    return f"(floor(({expr})*1e{places}+0.5e0)/1e{places})"


def units(expr: str, places: int) -> str:
    return f"CAST(floor(({expr})*1e{places}+0.5e0) AS BIGINT)"


def mean(expr: str, places: int) -> str:
    return (
        f"(CAST(sum({units(expr, places)}) AS DOUBLE)/CAST(count({expr}) AS DOUBLE)/1e{places})"
    )


def std(expr: str, places: int) -> str:
    n, s1 = f"CAST(count({expr}) AS DOUBLE)", f"CAST(sum({units(expr, places)}) AS DOUBLE)"
    s2 = f"CAST(sum({units(expr, places)}*{units(expr, places)}) AS DOUBLE)"
    variance = f"({s2}-{s1}*{s1}/{n})/nullif({n}-1e0,0e0)"
    return f"(CASE WHEN count({expr})>1 THEN sqrt(greatest({variance},0e0)) END/1e{places})"


def scaled(x: str, lo: str, hi: str) -> str:
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL ELSE "
        f"coalesce((CAST({x} AS DOUBLE)-{lo})/nullif(CAST({hi} AS DOUBLE)-{lo},0e0),0e0) END)"
    )


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def values(rows, names: str) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(float(v)) + "e0"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({names}))"


def cleaned(x: str) -> str:
    text = f"regexp_replace(lower(coalesce({x},'')), '^\\s+|\\s+$', '', 'g')"
    text = f"regexp_replace({text}, '^c\\s*\\(', '')"
    text = f"regexp_replace({text}, '\\)$', '')"
    text = f"regexp_replace({text}, '[!-/:-@\\[-`{{-~]', ' ', 'g')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


def keyed(x: str) -> str:
    return f"lower(trim(regexp_replace(CAST({x} AS VARCHAR), '\\s+', ' ', 'g')))"


def minutes(x: str) -> str:
    pattern = "^PT(?:(\\d+)H)?(?:(\\d+)M)?"
    return (
        f"(coalesce(TRY_CAST(regexp_extract({x}, '{pattern}', 1) AS BIGINT),0)*60"
        f"+coalesce(TRY_CAST(regexp_extract({x}, '{pattern}', 2) AS BIGINT),0))"
    )


def category(name: str) -> str:
    key = f"trim(translate(trim(lower({name})),'()','  '))"
    exact = " ".join(f"WHEN {key}='{t}' THEN '{c}'" for t, c in S.TAXONOMY)
    near = " ".join(
        f"WHEN contains('{t}',{key}) OR contains({key},'{t}') THEN '{c}'" for t, c in S.TAXONOMY
    )
    return f"(CASE {exact} {near} ELSE 'other' END)"


def singular(x: str) -> str:
    k = f"trim(translate(lower(trim(regexp_replace({x},'\\s+',' ','g'))),'()','  '))"
    return (
        f"(CASE WHEN length({k})>4 AND suffix({k},'ies') THEN substr({k},1,length({k})-3)||'y' "
        f"WHEN length({k})>4 AND suffix({k},'oes') THEN substr({k},1,length({k})-2) "
        f"WHEN length({k})>4 AND suffix({k},'s') AND NOT regexp_matches({k},'(ss|us|is|os|as)$') "
        f"THEN substr({k},1,length({k})-1) ELSE {k} END)"
    )


def hits(array: str, basket) -> str:
    terms = sorted(set(basket))
    return (
        f"list_filter([{quoted(terms)}], lambda b: len(list_filter(coalesce({array},[]), "
        "lambda i: contains(i,b) OR contains(b,i)))>0)"
    )


def display(x: str) -> str:
    spelled = x
    for key, name in K.COMPOUND_COUNTRIES.items():
        spelled = f"(CASE WHEN {x}='{key}' THEN '{name}' ELSE {spelled} END)"
    return (
        f"list_aggregate(list_transform(string_split({spelled},' '), "
        "lambda w: upper(substr(w,1,1))||lower(substr(w,2))),'string_agg',' ')"
    )


_R = S.RULES
_BOOST = (
    "CASE WHEN {a} AND coalesce({w},'') IN (" + quoted(_R.boosters_up) + ") THEN "
    f"{K.BOOST_UP}e0 WHEN {{a}} AND coalesce({{w}},'') IN (" + quoted(_R.boosters_down)
    + f") THEN {K.BOOST_DOWN}e0 ELSE 0e0 END"
)
_NEG = quoted(_R.negations)


def _step(distance: int, value: str) -> str:
    """Value after the word at this distance, as a SQL expression over the context row."""
    applies = f"(w{distance} IS NOT NULL AND v{distance} IS NULL)"
    boost = "(" + _BOOST.format(a=applies, w=f"w{distance}") + ")"
    pushed = (
        f"({value}+{boost}*{K.DAMPING[distance - 1]}e0*(CASE WHEN {value}<0 THEN -1e0 ELSE 1e0 END))"
    )
    rules = ""
    if distance > 1:
        nearer = [f"coalesce(w{d},'')" for d in range(1, distance)]
        emphasis = " OR ".join(f"{w} IN ('so','this')" for w in nearer)
        doubt = " OR ".join(f"{w}='doubt'" for w in nearer)
        rules = (
            f"WHEN w{distance}='never' AND ({emphasis}) THEN {K.NEVER_FACTOR}e0 "
            f"WHEN w{distance}='without' AND ({doubt}) THEN 1e0 "
        )
    factor = (
        f"(CASE WHEN NOT {applies} THEN 1e0 {rules}WHEN w{distance} IN ({_NEG}) "
        f"THEN {K.NEGATION_FACTOR}e0 ELSE 1e0 END)"
    )
    return f"{pushed}*{factor}"


def _phrases(value: str) -> str:
    """Value after idioms and phrase boosters."""

    def listed(names: str, entries) -> str:
        text = "||' '||".join(names.split())
        return "CASE " + " ".join(f"WHEN {text}='{p}' THEN {float(v)}e0" for p, v in entries) + " END"

    idioms = ", ".join(
        listed(names, _R.idioms)
        for names in ("w0 wn wn2", "w0 wn", "w1 w0", "w2 w1 w0", "w2 w1", "w3 w2 w1", "w3 w2")
    )
    pushed = "+".join(
        f"coalesce({listed(names, _R.phrase_boosters)},0e0)" for names in ("w3 w2 w1", "w3 w2", "w2 w1")
    )
    return f"coalesce({idioms}, {value})+{pushed}"


_C = "coalesce(w{0},'')"
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (tuple(needs.split()), sql)


# --- Bronze ------------------------------------------------------------------------
cte("ratings", "", """
SELECT CAST(l_partkey AS BIGINT) AS rid,
 CAST(sum(1 + CAST(l_quantity AS BIGINT) % 5) AS DOUBLE)/CAST(count(*) AS DOUBLE) AS rating,
 CAST(count(*) AS DOUBLE) AS reviews FROM lineitem GROUP BY 1""")
cte("bronze_recipes", "ratings", """
SELECT CAST(p_partkey AS BIGINT) AS RecipeId, upper(p_name)||'!' AS Name,
 'PT'||p_size||'M' AS CookTime,
 CASE WHEN p_size % 5 <> 0 THEN 'PT'||(p_size*2)||'M' END AS PrepTime,
 'PT'||((p_size*3)//60)||'H'||((p_size*3)%60)||'M' AS TotalTime, p_type AS RecipeCategory,
 'c("'||p_name||'", "'||split_part(p_name,' ',2)||(CASE WHEN p_size % 2 = 1 THEN 's' ELSE '' END)
  ||'", "'||p_type||'", "with the 12")' AS RecipeIngredientParts,
 rating AS AggregatedRating, reviews AS ReviewCount,
 'Take the '||p_name||'. Mix until smooth! 2. Serve with a '||lower(p_type)||' garnish.'
  AS RecipeInstructions
FROM part LEFT JOIN ratings ON rid = p_partkey""")
cte("shipped", "", """
SELECT l_orderkey, l_quantity, l_shipdate, n_nationkey, n_name, p_name, p_type
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey""")
cte("bronze_season", "shipped", """
SELECT product_name, product_type, month, country, 'EUFIC' AS source FROM
 (SELECT *, sum(q) OVER (PARTITION BY product_name, country) AS year FROM
  (SELECT split_part(p_name,' ',2) AS product_name, monthname(o_orderdate) AS month,
    n_name AS country, sum(CAST(l_quantity AS BIGINT)) AS q, min(p_type) AS product_type
   FROM shipped JOIN orders ON l_orderkey = o_orderkey GROUP BY 1,2,3))
WHERE q*12 > year""")
cte("bronze_production", "shipped", """
SELECT CAST(n_nationkey AS BIGINT) AS area_code, n_name AS area,
 CAST(ascii(word)*1000+ascii(substr(word,2,1)) AS BIGINT) AS item_code, word AS item,
 e AS element, CAST(y AS VARCHAR) AS year, 't' AS unit,
 CAST(CASE WHEN e='Production' THEN amount ELSE lots END AS VARCHAR) AS value
FROM (SELECT n_nationkey, n_name, word, year(l_shipdate) AS y,
   CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS amount, count(*) AS lots
  FROM (SELECT *, unnest(list_concat(string_split(p_name,' '), ['goods, total'])) AS word
        FROM shipped) GROUP BY ALL)
CROSS JOIN (VALUES ('Production'),('Area harvested')) AS x(e)""")

# --- Silver ------------------------------------------------------------------------
cte("recipes", "bronze_recipes", f"""
SELECT RecipeId AS recipeid, {cleaned('Name')} AS name, {minutes('CookTime')} AS cooktime,
 {minutes('PrepTime')} AS preptime, {minutes('TotalTime')} AS totaltime,
 {cleaned('RecipeCategory')} AS recipecategory,
 {cleaned('RecipeIngredientParts')} AS recipeingredientparts,
 coalesce(AggregatedRating,0e0) AS aggregatedrating, coalesce(ReviewCount,0e0) AS reviewcount,
 {cleaned('RecipeInstructions')} AS recipeinstructions FROM bronze_recipes""")
cte("reviews", "", f"""
SELECT doc_id AS reviewid, doc_id//2 AS recipeid, CAST(n_chars % 5 + 1 AS DOUBLE) AS rating,
 {cleaned('text')} AS review FROM documents""")
cte("season", "bronze_season", f"""
SELECT DISTINCT {keyed('product_name')} AS product_name, {keyed('product_type')} AS product_type,
 {keyed('month')} AS month, CAST(m AS BIGINT) AS month_number, {keyed('country')} AS country,
 TRUE AS is_in_season, 1e0 AS confidence_score, {keyed('source')} AS source
FROM bronze_season JOIN (VALUES {", ".join(f"('{k}',{v})" for k, v in K.MONTHS.items())}) AS t(k,m)
 ON k = {keyed('month')}""")
cte("production", "bronze_production", f"""
SELECT area_code, {keyed('area')} AS country_name, item_code, {keyed('item')} AS product_name,
 {keyed('element')} AS element, TRY_CAST(year AS BIGINT) AS year, {keyed('unit')} AS unit,
 TRY_CAST(value AS DOUBLE) AS production_value, 'faostat_qcl' AS source
FROM bronze_production WHERE element = 'Production' AND TRY_CAST(year AS BIGINT) IS NOT NULL
 AND TRY_CAST(value AS DOUBLE) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY area_code,item_code,year,element ORDER BY value) = 1""")

# --- Sentiment ---------------------------------------------------------------------
cte("lexicon", "", "SELECT * FROM " + values(S.LEXICON, "word, valence"))


def _sentiment(name: str, source: str) -> None:
    value = f"v0*(CASE WHEN {_C.format(1)}='no' OR {_C.format(2)}='no' OR ({_C.format(3)}='no' AND {_C.format(1)} IN ('or','nor')) THEN {K.NEGATION_FACTOR}e0 ELSE 1e0 END)"
    cte(f"{name}_lists", source, f"""
SELECT reviewid, recipeid, string_split(review,' ') AS list FROM {source}""")
    cte(f"{name}_contrast", f"{name}_lists", f"""
SELECT *, nullif(coalesce(list_position(list,'{_R.contrast}'),0),0)-1 AS contrast_at
FROM {name}_lists""")
    cte(f"{name}_words", f"{name}_contrast", f"""
SELECT reviewid, recipeid, contrast_at, unnest(list) AS w0, unnest(range(0,len(list))) AS pos
FROM {name}_contrast""")
    cte(f"{name}_near", f"{name}_words", f"""
SELECT *, lag(w0,1) OVER k AS w1, lag(w0,2) OVER k AS w2, lag(w0,3) OVER k AS w3,
 lead(w0,1) OVER k AS wn, lead(w0,2) OVER k AS wn2 FROM {name}_words WINDOW k AS (PARTITION BY reviewid ORDER BY pos)""")
    cte(f"{name}_found", f"{name}_near lexicon", f"""
SELECT c.*, valence AS v0 FROM {name}_near c JOIN lexicon ON word=w0""")
    cte(f"{name}_context", f"{name}_found lexicon", f"""
SELECT c.*, l1.valence AS v1, l2.valence AS v2, l3.valence AS v3, ln.valence AS vn
FROM {name}_found c LEFT JOIN lexicon l1 ON l1.word=w1
LEFT JOIN lexicon l2 ON l2.word=w2 LEFT JOIN lexicon l3 ON l3.word=w3
LEFT JOIN lexicon ln ON ln.word=wn""")
    cte(f"{name}_one", f"{name}_context", f"SELECT *, {value} AS a0 FROM {name}_context")
    cte(f"{name}_two", f"{name}_one", f"SELECT *, {_step(1, 'a0')} AS a1 FROM {name}_one")
    cte(f"{name}_three", f"{name}_two", f"SELECT *, {_step(2, 'a1')} AS a2 FROM {name}_two")
    cte(f"{name}_four", f"{name}_three", f"SELECT *, {_step(3, 'a2')} AS a3 FROM {name}_three")
    cte(f"{name}_five", f"{name}_four", f"""
SELECT *, CASE WHEN w3 IS NOT NULL AND v3 IS NULL THEN {_phrases('a3')} ELSE a3 END AS a4 FROM {name}_four""")
    cte(f"{name}_value", f"{name}_five", f"""
SELECT reviewid, CASE WHEN w0 IN ({quoted(_R.boosters_up + _R.boosters_down)})
  OR (w0='kind' AND wn='of') OR (w0='no' AND vn IS NOT NULL) THEN 0e0 ELSE
 a4*(CASE WHEN w1='least' AND v1 IS NULL AND {_C.format(2)} NOT IN ('at','very')
   THEN {K.NEGATION_FACTOR}e0 ELSE 1e0 END)
 *(CASE WHEN pos<contrast_at THEN {K.BEFORE_CONTRAST}e0 WHEN pos>contrast_at
   THEN {K.AFTER_CONTRAST}e0 ELSE 1e0 END) END AS v FROM {name}_five""")
    cte(f"{name}_total", f"{name}_value {source}", f"""
SELECT reviewid, recipeid, coalesce(u,0)/1e9 AS total FROM {source} LEFT JOIN
 (SELECT reviewid, CAST(sum({units('v', 9)}) AS BIGINT) AS u FROM {name}_value GROUP BY 1)
 USING (reviewid)""")
    compound = rnd("total/sqrt(total*total+15e0)", 4)
    cte(name, f"{name}_total", f"""
SELECT reviewid, recipeid, {rnd(f'({compound}+1e0)/2e0*1e2', 2)} AS sentiment_score
FROM {name}_total""")


_sentiment("scored", "reviews")
cte("chat_reviews", "", f"""
SELECT 1000000000000+conv_id*100000+turn AS reviewid, conv_id AS recipeid,
 {cleaned('text')} AS review FROM conversations""")
_sentiment("scored_chat", "chat_reviews")
cte("recipe_sentiment", "scored", f"""
SELECT recipeid, {rnd(mean('sentiment_score', 2), 2)} AS mean_sentiment_score,
 count(sentiment_score) AS review_count,
 coalesce({rnd(std('sentiment_score', 2), 2)},0e0) AS std_sentiment FROM scored GROUP BY 1""")
cte("sentiment", "recipe_sentiment", f"""
SELECT *, {rnd('(rank() OVER (ORDER BY mean_sentiment_score) + (count(*) OVER (PARTITION BY mean_sentiment_score)-1)/2e0)/count(*) OVER ()*1e2', 2)}
 AS sentiment_percentile FROM recipe_sentiment""")

# --- Recommendation score -------------------------------------------------------------
cte("reviewed", "recipes", "SELECT * FROM recipes WHERE reviewcount > 0")
cte("prior", "reviewed", f"""
SELECT {mean('aggregatedrating', 6)} AS prior_mean, quantile_cont(reviewcount,0.8) AS prior_weight
FROM reviewed""")
cte("weighted", "reviewed prior", """
SELECT r.*, prior_mean, prior_weight, reviewcount/(reviewcount+prior_weight)*aggregatedrating
 +prior_weight/(reviewcount+prior_weight)*prior_mean AS weighted FROM reviewed r CROSS JOIN prior""")
cte("bounds", "weighted", """
SELECT min(weighted) AS wl, max(weighted) AS wh, min(reviewcount) AS rl, max(reviewcount) AS rh,
 min(totaltime) AS tl, max(totaltime) AS th FROM weighted""")
cte("joined", "weighted bounds sentiment", f"""
SELECT w.*, {scaled('weighted', 'wl', 'wh')} AS ws, {scaled('reviewcount', 'rl', 'rh')} AS ps,
 1e0-{scaled('totaltime', 'tl', 'th')} AS ss,
 coalesce(s.sentiment_percentile,50e0) AS sentiment_percentile,
 reviewcount/(reviewcount+prior_weight)*coalesce(s.sentiment_percentile,50e0)
  +prior_weight/(reviewcount+prior_weight)*50e0 AS shrunk
FROM weighted w CROSS JOIN bounds LEFT JOIN sentiment s ON s.recipeid = w.recipeid""")


def composite(ws: str, sh: str) -> str:
    return rnd(f"(0.35e0*{ws}+0.25e0*({sh}/1e2)+0.2e0*ps+0.2e0*ss)*1e2", 2)


cte("recommendations", "joined", f"""
SELECT recipeid, name, recipecategory, recipeingredientparts, recipeinstructions, totaltime,
 CASE WHEN trim(recipeingredientparts)='' THEN 0
  ELSE len(string_split_regex(trim(recipeingredientparts),'\\s+')) END AS ingredient_count,
 aggregatedrating, CAST(reviewcount AS BIGINT) AS reviewcount,
 {rnd('weighted', 4)} AS weighted_rating, sentiment_percentile,
 {rnd('shrunk', 2)} AS shrunk_sentiment, ws AS rating_score, ps AS popularity_score,
 ss AS simplicity_score, {composite('ws', 'shrunk')} AS appeal_score FROM joined""")

# --- Matching ----------------------------------------------------------------------
cte("vocabulary", "season production", """
SELECT term, CAST(min(p) AS BIGINT) AS priority, CASE WHEN min(p)=0 THEN 'eufic' ELSE 'faostat' END AS source
FROM (SELECT product_name AS term, 0 AS p FROM season UNION ALL
      SELECT product_name, 1 FROM production) GROUP BY 1""")


def grams(source: str, column: str, carry: str) -> str:
    words = f"(SELECT {carry}, ' '||unnest(string_split({column},' '))||' ' AS pw FROM {source})"
    return (
        f"SELECT {carry}, substr(pw, i, 3) AS ngram FROM (SELECT *, unnest(range(1, "
        f"greatest(length(pw)-2,1)+1)) AS i FROM {words}) UNION ALL "
        f"SELECT {carry}, substr(pw, i, 4) FROM (SELECT *, unnest(range(1, length(pw)-2)) AS i "
        f"FROM {words} WHERE length(pw)>=4)"
    )


cte("term_counts", "vocabulary", f"""
SELECT term, source, priority, ngram, CAST(count(*) AS DOUBLE) AS tf
FROM ({grams('vocabulary', 'term', 'term, source, priority')}) GROUP BY ALL""")
cte("idf", "term_counts vocabulary", """
SELECT ngram, ln((1e0+(SELECT count(*) FROM vocabulary))/(1e0+count(*)))+1e0 AS idf
FROM term_counts GROUP BY 1""")
cte("ngram_index", "term_counts idf", """
SELECT term, source, priority, ngram, idf, raw/sqrt(sum(raw*raw) OVER (PARTITION BY term)) AS weight
FROM (SELECT c.*, idf, (1e0+ln(tf))*idf AS raw FROM term_counts c JOIN idf USING (ngram))""")
cte("raw_tokens", "recipes", f"""
SELECT recipeid, tok AS ingredient_token, min(p) AS pos FROM
 (SELECT recipeid, unnest(string_split(recipeingredientparts,' ')) AS tok,
   generate_subscripts(string_split(recipeingredientparts,' '),1) AS p FROM recipes)
WHERE tok NOT IN ({quoted(K.STOP_WORDS)}) AND NOT regexp_full_match(tok,'[0-9]+')
 AND length(tok) >= 3 GROUP BY 1,2""")
cte("tokens", "raw_tokens", "SELECT DISTINCT ingredient_token FROM raw_tokens")
cte("token_units", "tokens idf", f"""
SELECT ingredient_token, ngram, raw/sqrt(sum(raw*raw) OVER (PARTITION BY ingredient_token)) AS unit
FROM (SELECT ingredient_token, ngram, (1e0+ln(CAST(count(*) AS DOUBLE)))*any_value(idf) AS raw
 FROM ({grams('tokens', 'ingredient_token', 'ingredient_token')}) JOIN idf USING (ngram)
 GROUP BY 1,2)""")
cte("pair_scores", "token_units ngram_index", f"""
SELECT ingredient_token, term, source, priority, {rnd('sum(unit*weight)', 10)} AS score
FROM token_units JOIN ngram_index USING (ngram) GROUP BY 1,2,3,4""")
cte("best_terms", "tokens pair_scores vocabulary", f"""
SELECT ingredient_token, coalesce(b.term, f.term) AS best_term, coalesce(b.source, f.source)
 AS best_source, coalesce({rnd('score', 4)},0e0) AS similarity_score
FROM tokens LEFT JOIN (SELECT * FROM pair_scores QUALIFY row_number() OVER (PARTITION BY
  ingredient_token ORDER BY score DESC, priority, term)=1) b USING (ingredient_token)
CROSS JOIN (SELECT term, source FROM vocabulary ORDER BY priority, term LIMIT 1) f""")
ROOT = (
    "(CASE WHEN trim(regexp_replace(best_term,'\\s*\\(.*?\\)','','g'))='' "
    "THEN split_part(best_term,' ',1) "
    "ELSE split_part(trim(regexp_replace(best_term,'\\s*\\(.*?\\)','','g')),' ',1) END)"
)
cte("guarded", "best_terms", f"""
SELECT *, {ROOT} AS root, (ingredient_token={ROOT} OR rtrim(ingredient_token,'s')=rtrim({ROOT},'s')
 OR (starts_with(ingredient_token,{ROOT}) AND length(ingredient_token)-length({ROOT})<=2)
 OR (starts_with({ROOT},ingredient_token) AND length({ROOT})-length(ingredient_token)<=2)) AS family,
 similarity_score>=0.35e0 AS close FROM best_terms""")
cte("matches", "guarded", f"""
SELECT ingredient_token, CASE WHEN close AND family THEN best_term END AS matched_term,
 similarity_score, CASE WHEN close AND family THEN best_source ELSE 'unmatched' END AS source,
 close AND NOT family AS revoked,
 CASE WHEN close AND family THEN {category('best_term')} ELSE 'other' END AS ingredient_category
FROM guarded""")
cte("recipe_matches", "raw_tokens matches", """
SELECT recipeid, ingredient_token, matched_term, coalesce(source,'unmatched') AS source,
 similarity_score, coalesce(ingredient_category,'other') AS ingredient_category, pos,
 coalesce(source='eufic' AND ingredient_category IN ('fruit','vegetable'), FALSE) AS seasonal
FROM raw_tokens LEFT JOIN matches USING (ingredient_token)""")
cte("recipe_map", "recipes recipe_matches", """
SELECT r.recipeid, count(*) FILTER (source='eufic') AS eufic_match_count,
 count(*) FILTER (source='faostat') AS faostat_match_count,
 count(*) FILTER (source='unmatched') AS unmatched_count,
 coalesce(list(matched_term ORDER BY pos) FILTER (matched_term IS NOT NULL),[]) AS matched_ingredients,
 coalesce(list(ingredient_category ORDER BY pos) FILTER (matched_term IS NOT NULL),[])
  AS ingredient_categories,
 coalesce(list(matched_term ORDER BY pos) FILTER (matched_term IS NOT NULL AND seasonal),[])
  AS seasonal_ingredients,
 coalesce(list(matched_term ORDER BY pos) FILTER (matched_term IS NOT NULL AND NOT seasonal),[])
  AS complementary_ingredients
FROM recipes r LEFT JOIN recipe_matches m ON m.recipeid=r.recipeid GROUP BY 1""")

# --- Segments ----------------------------------------------------------------------
cte("feature_rows", "recommendations sentiment recipe_map", """
SELECT r.recipeid, appeal_score, r.sentiment_percentile, simplicity_score,
 CAST(eufic_match_count AS DOUBLE) AS eufic_match_count, totaltime, rating_score,
 mean_sentiment_score, faostat_match_count, unmatched_count
FROM recommendations r LEFT JOIN sentiment s ON s.recipeid=r.recipeid
LEFT JOIN recipe_map m ON m.recipeid=r.recipeid""")
cte("clipped", "feature_rows", """
SELECT * REPLACE (CASE WHEN totaltime IS NOT NULL THEN least(CAST(totaltime AS DOUBLE),
 (SELECT quantile_cont(CAST(totaltime AS DOUBLE),0.99) FROM feature_rows)) END AS totaltime)
FROM feature_rows""")
cte("inverted", "clipped", """
SELECT *, (SELECT max(totaltime) FROM clipped)-totaltime AS totaltime_inverted FROM clipped""")
cte("features", "inverted", "SELECT recipeid, " + ", ".join(
    scaled(c, f"(SELECT min({c}) FROM inverted)", f"(SELECT max({c}) FROM inverted)") + f" AS {c}"
    for c in K.SEGMENT_FEATURES) + " FROM inverted")
cte("assigned", "features", """
SELECT f.*, CAST(regexp_extract(p_brand,'(\\d+)',1) AS BIGINT)%5 AS cluster_id
FROM features f JOIN part ON p_partkey=recipeid""")
cte("profile_means", "assigned", "SELECT cluster_id, " + ", ".join(
    f"{mean(c, 9)} AS {c}" for c in K.SEGMENT_FEATURES
) + ", count(*) AS recipe_count FROM assigned GROUP BY 1")
_taken: list[str] = []
for _i, (_label, _feature) in enumerate(K.SEGMENT_LABELS):
    _free = " AND ".join(f"cluster_id <> (SELECT cluster_id FROM {t})" for t in _taken)
    cte(f"winner{_i}", " ".join(["profile_means", *_taken]), f"""
SELECT cluster_id, '{_label}' AS label FROM profile_means {'WHERE ' + _free if _free else ''}
ORDER BY {_feature} DESC, cluster_id LIMIT 1""")
    _taken.append(f"winner{_i}")
cte("profiles", "profile_means " + " ".join(_taken), f"""
SELECT p.*, coalesce(label,'{K.SEGMENT_FALLBACK}') AS cluster_label FROM profile_means p LEFT JOIN (
""" + " UNION ALL ".join(f"SELECT * FROM {t}" for t in _taken) + ") w ON w.cluster_id=p.cluster_id")
cte("clusters", "assigned profiles", """
SELECT recipeid, cluster_id, cluster_label FROM assigned JOIN profiles USING (cluster_id)""")

# --- Sustainability ----------------------------------------------------------------
cte("season_ref", "season", """
SELECT DISTINCT country, month_number, product_name FROM season WHERE is_in_season""")
cte("avail", "production", f"""
SELECT country_name AS country, product_name, {scaled('production_value', 'lo', 'hi')} AS a
FROM (SELECT *, min(production_value) OVER (PARTITION BY country_name) AS lo,
  max(production_value) OVER (PARTITION BY country_name) AS hi FROM production p
  WHERE year=(SELECT max(year) FROM production q WHERE q.country_name=p.country_name))
QUALIFY row_number() OVER (PARTITION BY country_name, product_name ORDER BY item_code)=1""")
cte("prepared", "recipe_matches", """
SELECT DISTINCT recipeid, matched_term FROM recipe_matches
WHERE matched_term IS NOT NULL AND source<>'unmatched'""")
cte("coverage", "recipe_matches", f"""
SELECT recipeid, count(DISTINCT ingredient_token) AS total_ingredient_tokens,
 count(matched_term) AS matched_ingredient_tokens,
 {rnd('CAST(count(matched_term) AS DOUBLE)/CAST(count(DISTINCT ingredient_token) AS DOUBLE)*1e2', 2)}
 AS coverage_score FROM recipe_matches GROUP BY 1""")
cte("term_contexts", "prepared season season_ref avail", """
SELECT t.matched_term, c.country, m.m AS score_month,
 CASE WHEN s.product_name IS NULL THEN 0e0 ELSE 1e0 END AS seasonality_score,
 coalesce(a.a,0e0) AS availability_score
FROM (SELECT DISTINCT matched_term FROM prepared) t
CROSS JOIN (SELECT DISTINCT country FROM season) c
CROSS JOIN (SELECT unnest(range(1,13)) AS m) m
LEFT JOIN season_ref s ON s.product_name=t.matched_term AND s.country=c.country
 AND s.month_number=m.m
LEFT JOIN avail a ON a.product_name=t.matched_term AND a.country=c.country""")
cte("context_sums", "prepared term_contexts", f"""
SELECT recipeid, country, score_month, CAST(count(*) AS DOUBLE) AS n,
 CAST(sum(seasonality_score) AS DOUBLE) AS s,
 CAST(sum({units('availability_score', 12)}) AS DOUBLE)/1e12 AS a,
 count(*) FILTER (seasonality_score>0 OR availability_score>0) AS p
FROM prepared JOIN term_contexts USING (matched_term) GROUP BY 1,2,3""")
cte("sustainability", "context_sums coverage", f"""
SELECT recipeid, country AS score_country, score_month, CAST(n AS BIGINT) AS recognized_ingredient_count,
 total_ingredient_tokens, matched_ingredient_tokens, {rnd('s/n*1e2', 2)} AS seasonality_score,
 {rnd('a/n*1e2', 2)} AS availability_score,
 {rnd('(0.75e0*s+0.25e0*a)/n*1e2', 2)} AS sustainability_mean,
 {rnd('CAST(p AS DOUBLE)/n*1e2', 2)} AS positive_ratio,
 {rnd('least((0.75e0*s+0.25e0*a)/n*1e2+(CASE WHEN p*3>=n*2 THEN 10e0 ELSE 0e0 END),100e0)', 2)}
 AS sustainability_score, coverage_score
FROM context_sums JOIN coverage USING (recipeid)""")

# --- Serving -----------------------------------------------------------------------
SERVED = (
    "seasonality_score", "availability_score", "sustainability_mean", "positive_ratio",
    "sustainability_score", "coverage_score",
)
cte("serving", "recommendations sustainability clusters recipe_map", f"""
SELECT r.*, {', '.join(f'coalesce(d.{c},0e0) AS {c}' for c in SERVED)}, c.cluster_id,
 c.cluster_label, m.* EXCLUDE (recipeid)
FROM recommendations r
LEFT JOIN (SELECT * FROM sustainability WHERE score_country='{S.COUNTRY}'
  AND score_month={S.MONTH}) d ON d.recipeid=r.recipeid
LEFT JOIN clusters c ON c.recipeid=r.recipeid LEFT JOIN recipe_map m ON m.recipeid=r.recipeid""")
cte("country_flags", "season production", """
SELECT country, bool_or(e) AS eufic, bool_or(f) AS faostat FROM
 (SELECT country, TRUE AS e, FALSE AS f FROM season UNION ALL
  SELECT country_name, FALSE, TRUE FROM production) GROUP BY 1""")


def using(needs: str, select: str) -> str:
    """``select`` preceded by the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dependency in CTES[name][0]:
            visit(dependency)
        ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return select
    body = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in ordered)
    return f"WITH {body}\n{select}"

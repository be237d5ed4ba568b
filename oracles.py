"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import math

# One posting for each order.
_RAW = """
lists AS (
  SELECT l_orderkey, list_sort(list_distinct(list(p_brand))) AS skills
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
),
unlabelled AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS job_id, c_mktsegment AS job_title, c_name AS company,
    CASE WHEN o_orderstatus = 'O' THEN 'Remote' ELSE n_name END AS location,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Lead' WHEN '2' THEN 'Senior'
      WHEN '3' THEN 'Mid-level' ELSE 'Entry-level' END AS experience_level,
    CASE o_orderstatus WHEN 'O' THEN 'Remote' WHEN 'P' THEN 'Hybrid' ELSE 'Onsite' END AS job_type,
    o_totalprice AS salary, skills, r_name AS industry,
    strftime(o_orderdate, '%Y-%m-%d') AS post_date, o_custkey AS customer
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN lists ON o_orderkey = l_orderkey
),
pointed AS (
  SELECT *, (CASE WHEN job_type = 'Remote' THEN 2 ELSE 0 END)
    + (CASE WHEN coalesce(list_has_any(skills, ['Brand#1', 'Brand#2', 'Brand#3', 'Brand#4']), false) THEN 2 ELSE 0 END)
    + (CASE WHEN experience_level IN ('Entry-level', 'Mid-level') THEN 1 ELSE 0 END)
    + (CASE WHEN industry IN ('ASIA', 'EUROPE') THEN 1 ELSE 0 END) AS points
  FROM unlabelled
),
raw AS (
  SELECT *, CASE WHEN points >= 5 THEN 'High' WHEN points >= 3 THEN 'Medium' ELSE 'Low' END AS demand_score,
    CASE WHEN points >= 4 THEN 'High' WHEN points >= 2 THEN 'Medium' ELSE 'Low' END AS other_demand
  FROM pointed
)"""

_CLEAN = f"""{_RAW},
postings AS (
  SELECT *, CAST(CAST(salary AS DECIMAL(28,6)) * 1000000 AS HUGEINT) AS millionths FROM raw
  WHERE job_title IS NOT NULL AND salary IS NOT NULL AND NOT isnan(salary) AND skills IS NOT NULL
)"""

_MEAN = "CAST((2 * sum(millionths) + 10000 * count(millionths)) // (20000 * count(millionths)) AS DOUBLE) / 100"
_REMOTE = "CAST(count(*) FILTER (WHERE job_type = 'Remote') AS DOUBLE)"

_SKILLS = f"""{_CLEAN},
listed AS (SELECT job_id, millionths, unnest(skills) AS skill FROM postings),
skill_stats AS (
  SELECT skill, count(job_id) AS frequency, {_MEAN} AS avg_salary FROM listed GROUP BY skill
)"""

_BAND = """CASE WHEN salary < 60000 THEN 'Under $60k' WHEN salary < 90000 THEN '$60k - $90k'
  WHEN salary < 120000 THEN '$90k - $120k' WHEN salary < 150000 THEN '$120k - $150k'
  WHEN salary < 180000 THEN '$150k - $180k' ELSE 'Over $180k' END"""


def _premium(skills: str) -> str:
    a = ", ".join(f"'Brand#{i}'" for i in range(1, 6))
    b = ", ".join(f"'Brand#{i}'" for i in range(6, 11))
    return (
        f"(8000 * len([x FOR x IN {skills} IF x IN ({a})])"
        f" + 4000 * len([x FOR x IN {skills} IF x IN ({b})]))"
    )


def _pay(skills: str) -> str:
    """Expected salary; every term is a multiple of 100, so there is nothing to round."""
    return f"""CAST(greatest(30000,
      (CASE job_title WHEN 'AUTOMOBILE' THEN 95000 WHEN 'BUILDING' THEN 85000 WHEN 'FURNITURE' THEN 90000
        WHEN 'HOUSEHOLD' THEN 105000 WHEN 'MACHINERY' THEN 125000 END)
      * (CASE experience_level WHEN 'Entry-level' THEN 70 WHEN 'Mid-level' THEN 100 WHEN 'Senior' THEN 140
        WHEN 'Lead' THEN 170 END) // 100
      + {_premium(skills)}
      + (CASE job_type WHEN 'Remote' THEN 5000 WHEN 'Onsite' THEN -3000 ELSE 0 END)) AS BIGINT)"""


_FLAT = """job_id, job_title, company, location, experience_level, job_type, salary,
  array_to_string(skills, ',') AS skills, industry, post_date, demand_score"""

_FEATURES = f"""{_CLEAN},
features AS (
  SELECT job_id, 'job_title_' || job_title AS feature FROM postings
  UNION ALL SELECT job_id, 'experience_level_' || experience_level FROM postings
  UNION ALL SELECT job_id, 'job_type_' || job_type FROM postings
  UNION ALL SELECT job_id, 'industry_' || industry FROM postings
  UNION ALL SELECT job_id, unnest(skills) FROM postings
)"""

_VALUES = f"""{_CLEAN},
found AS (
  SELECT 'job_title' AS field, job_title AS value FROM postings
  UNION SELECT 'experience_level', experience_level FROM postings
  UNION SELECT 'job_type', job_type FROM postings
  UNION SELECT 'industry', industry FROM postings
  UNION SELECT 'skills', unnest(skills) FROM postings
)"""

# The people's comma lists.
_USERS = f"""{_SKILLS},
known AS (
  SELECT customer, list_sort(list_distinct(list(skill))) AS all_skills
  FROM (SELECT customer, unnest(skills) AS skill FROM postings) GROUP BY customer
),
users AS (
  SELECT customer AS user_id,
    CASE WHEN customer % 11 = 0 THEN ' , '
      WHEN customer % 13 = 0 THEN array_to_string(all_skills, ',')
      WHEN customer % 17 = 0 THEN 'Cobol,, ' || array_to_string(all_skills, ' , ')
      ELSE array_to_string(all_skills, ' , ') END AS skills
  FROM known
),
parsed AS (
  SELECT user_id, [trim(x) FOR x IN string_split(skills, ',') IF trim(x) <> ''] AS own
  FROM users
)"""

_SEARCH = f"""WITH {_RAW} SELECT {_FLAT} FROM raw WHERE {{}} ORDER BY job_id LIMIT 40"""


def _what_if(rank_by: str) -> str:
    return f"""WITH {_SKILLS},
names AS (SELECT list(skill ORDER BY {rank_by}) AS all_skills FROM skill_stats),
tried AS (
  SELECT p.*, [s FOR s IN all_skills IF NOT list_contains(skills, s)][1:15] AS candidates
  FROM postings p, names
),
pairs AS (
  SELECT *, unnest(candidates) AS skill, unnest(range(1, len(candidates) + 1)) AS pos FROM tried
),
gains AS (
  SELECT job_id AS request_id, skill, pos, {_pay("list_append(skills, skill)")} - {_pay("skills")} AS boost_amount
  FROM pairs
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY boost_amount DESC, pos) AS rank
  FROM gains WHERE boost_amount > 500
)
SELECT request_id, CAST(rank AS BIGINT) AS rank, skill, boost_amount FROM ranked WHERE rank <= 3"""


_PER_CLASS = f"""WITH {_CLEAN},
classes AS (SELECT unnest(['Low', 'Medium', 'High']) AS class),
counts AS (
  SELECT class, count(*) FILTER (WHERE demand_score = class) AS support,
    count(*) FILTER (WHERE other_demand = class) AS predicted,
    count(*) FILTER (WHERE demand_score = class AND other_demand = class) AS hit
  FROM classes CROSS JOIN postings GROUP BY class
),
scores AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p,
    CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hit / (predicted + support) END AS f
  FROM counts
)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score,
  CAST(support AS BIGINT) AS support FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT)
  FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores"""

_FRAMEWORKS = """
frameworks(framework, step, title, description, base_skills) AS (VALUES
  ('Analyst', 1, 'Query', 'Ask tables.', ['Brand#1', 'Brand#2']),
  ('Analyst', 2, 'Show', 'Draw charts.', ['Brand#3']),
  ('Analyst', 3, 'Share', 'Keep versions.', ['Brand#4', 'Brand#99']),
  ('Builder', 1, 'Store', 'Lay out files.', ['Brand#5']),
  ('Builder', 2, 'Move', 'Load and join.', ['Brand#6', 'Brand#7', 'Brand#8']),
  ('Builder', 3, 'Run', 'Schedule jobs.', ['Brand#9']),
  ('Modeler', 1, 'Prepare', 'Clean and encode.', ['Brand#10', 'Brand#11']),
  ('Modeler', 2, 'Fit', 'Train and judge.', ['Brand#12']),
  ('Modeler', 3, 'Serve', 'Score tables.', ['Brand#13', 'Brand#14'])
)"""

_OVERALL = f"""SELECT count(*) AS total_jobs, {_MEAN} AS average_salary,
  CASE WHEN count(*) = 0 THEN 0 ELSE floor({_REMOTE} * 10000.0 / count(*) + 0.5) / 100 END AS remote_percentage
  FROM postings"""
_BY_TITLE = f"""SELECT job_title, experience_level, {_MEAN} AS avg_salary, count(job_id) AS job_count
  FROM postings GROUP BY ALL"""
_BY_INDUSTRY = f"""SELECT industry, count(job_id) AS job_count, {_MEAN} AS avg_salary,
  floor({_REMOTE} * 10000.0 / count(job_id) + 0.5) / 100 AS remote_percentage FROM postings GROUP BY industry"""
_BY_BAND = f'SELECT {_BAND} AS salary_band, count(*) AS "count" FROM postings GROUP BY 1'
_WIDE_LABELS = (
    "['Under $60k', '$60k - $120k', '$120k - $240k', '$240k - $600k', '$600k - $900k', 'Over $900k']"
)

# The raw postings with nulls, repeats and fractions by residues of the order's number.
_ODD = f"""{_RAW},
odd AS (
  SELECT * EXCLUDE (n) REPLACE (
      CASE WHEN n % 37 = 0 OR n % 19 <> 0 THEN job_id END AS job_id,
      CASE WHEN n % 37 = 0 THEN '100% ' || job_title WHEN n % 23 <> 0 THEN job_title END AS job_title,
      CASE WHEN n % 17 <> 0 THEN experience_level END AS experience_level,
      salary + (n % 10000) / 10000.0::DOUBLE AS salary,
      CASE WHEN n % 29 = 0 THEN [] WHEN n % 31 = 0 AND skills IS NOT NULL THEN list_concat(skills, skills) ELSE skills END AS skills)
  FROM (SELECT *, CAST(job_id AS BIGINT) AS n FROM raw)
),
postings AS (
  SELECT *, CAST(CAST(salary AS DECIMAL(28,6)) * 1000000 AS HUGEINT) AS millionths FROM odd
  WHERE job_title IS NOT NULL AND salary IS NOT NULL AND skills IS NOT NULL
)"""
_ODD_SKILLS = f"""{_ODD},
listed AS (SELECT job_id, millionths, unnest(skills) AS skill FROM postings),
skill_stats AS (SELECT skill, count(job_id) AS frequency, {_MEAN} AS avg_salary FROM listed GROUP BY skill)"""

_ODD_PAY = f"""CASE WHEN job_title NOT LIKE '100%' AND experience_level IS NOT NULL THEN CAST(greatest(30000, 100 * round_even((
      (CASE job_title WHEN 'AUTOMOBILE' THEN 95130 WHEN 'BUILDING' THEN 85055 WHEN 'FURNITURE' THEN 21017
        WHEN 'HOUSEHOLD' THEN 105250 WHEN 'MACHINERY' THEN 125199 END)
      * (CASE experience_level WHEN 'Entry-level' THEN 70 WHEN 'Mid-level' THEN 100 WHEN 'Senior' THEN 140
        WHEN 'Lead' THEN 170 END)
      + 100 * ({_premium('skills')} + (CASE job_type WHEN 'Remote' THEN 5000 WHEN 'Onsite' THEN -3000 ELSE 0 END))
    ) / 10000, 0)) AS BIGINT) END"""

_ODD_REPORT = _PER_CLASS.replace(_CLEAN, f"""{_ODD.replace('postings AS (', 'whole AS (')},
postings AS (
  SELECT * REPLACE (CASE WHEN experience_level IS NOT NULL THEN other_demand END AS other_demand) FROM whole
)""")

# A regression tree of depth 2 on the premium of the skills, fitted on all postings.
_TREE = f"""{_FEATURES},
target AS (SELECT job_id, CAST({_premium('skills')} AS DOUBLE) AS y FROM postings),
names AS (SELECT DISTINCT feature FROM features),
total AS (SELECT count(*) AS n, sum(y) AS s FROM target),
first_gains AS (
  SELECT feature, s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n AS gain
  FROM (SELECT feature, count(*) AS n1, sum(y) AS s1 FROM features JOIN target USING (job_id) GROUP BY feature), total
  WHERE n1 < n
),
first_split AS (SELECT feature AS f1, gain FROM first_gains ORDER BY gain DESC, feature LIMIT 1),
sided AS (
  SELECT job_id, y, job_id IN (SELECT job_id FROM features WHERE feature = (SELECT f1 FROM first_split)) AS side
  FROM target
),
side_total AS (SELECT side, count(*) AS n, sum(y) AS s FROM sided GROUP BY side),
second_gains AS (
  SELECT side, feature, s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n AS gain
  FROM (SELECT side, feature, count(*) AS n1, sum(y) AS s1 FROM features JOIN sided USING (job_id) GROUP BY ALL)
  JOIN side_total USING (side) WHERE n1 < n
),
second_split AS (
  SELECT side, feature AS f2, gain FROM second_gains
  QUALIFY row_number() OVER (PARTITION BY side ORDER BY gain DESC, feature) = 1
),
leaves AS (
  SELECT side, job_id IN (SELECT job_id FROM features f WHERE f.feature = f2) AS second, avg(y) AS mean
  FROM sided JOIN second_split USING (side) GROUP BY ALL
),
gains AS (
  SELECT feature, sum(gain) AS gain FROM (
    SELECT f1 AS feature, gain FROM first_split UNION ALL SELECT f2, gain FROM second_split) GROUP BY feature
),
importances AS (
  SELECT n.feature, round(coalesce(gain, 0) / (SELECT sum(gain) FROM gains), 6) AS importance
  FROM names n LEFT JOIN gains g ON n.feature = g.feature
)"""
# A 32-bit draw counts once for each of these it reaches: the distribution of Poisson with mean 1.
_POISSON = [math.floor(2**32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(13)]
_DRAWN = " + ".join(f"CASE WHEN u >= {step} THEN 1 ELSE 0 END" for step in _POISSON if step < 2**32 - 1)
_BAGGED = f"""{_FEATURES},
target AS (SELECT job_id, CAST({_premium('skills')} AS DOUBLE) AS y FROM postings),
draws AS (
  SELECT job_id, y, t AS tree, CAST('0x' || substr(md5(job_id || '/42/' || t), 1, 8) AS BIGINT) AS u
  FROM target, range(3) r(t)
),
bag AS (SELECT * FROM (SELECT job_id, y, tree, CAST({_DRAWN} AS DOUBLE) AS w FROM draws) WHERE w > 0),
total AS (SELECT tree, sum(w) AS n, sum(w * y) AS s FROM bag GROUP BY tree),
first_split AS (
  SELECT tree, feature AS f1 FROM (
    SELECT tree, feature, sum(w) AS n1, sum(w * y) AS s1 FROM features JOIN bag USING (job_id) GROUP BY ALL)
  JOIN total USING (tree) WHERE n1 < n
  QUALIFY row_number() OVER (
    PARTITION BY tree ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n DESC, feature) = 1
),
everyone AS (
  SELECT p.job_id, t.tree, f.job_id IS NOT NULL AS side
  FROM target p CROSS JOIN first_split t LEFT JOIN features f ON f.job_id = p.job_id AND f.feature = t.f1
),
sided AS (SELECT b.*, e.side FROM bag b JOIN everyone e USING (job_id, tree)),
side_total AS (SELECT tree, side, sum(w) AS n, sum(w * y) AS s FROM sided GROUP BY ALL),
second_split AS (
  SELECT tree, side, feature AS f2 FROM (
    SELECT tree, side, feature, sum(w) AS n1, sum(w * y) AS s1 FROM features JOIN sided USING (job_id) GROUP BY ALL)
  JOIN side_total USING (tree, side) WHERE n1 < n
  QUALIFY row_number() OVER (
    PARTITION BY tree, side ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n DESC, feature) = 1
),
placed AS (
  SELECT e.*, f.job_id IS NOT NULL AS second
  FROM everyone e JOIN second_split t USING (tree, side)
  LEFT JOIN features f ON f.job_id = e.job_id AND f.feature = t.f2
),
leaves AS (
  SELECT tree, side, second, sum(w * y) / sum(w) AS mean FROM bag JOIN placed USING (job_id, tree) GROUP BY ALL
)
SELECT job_id AS request_id, CAST(round(CAST(sum(mean) / 3 AS DECIMAL(28,6)), 2) AS DOUBLE) AS predicted_salary
FROM placed JOIN leaves USING (tree, side, second) GROUP BY job_id"""
_TREE_WHAT_IF = f"""WITH {_TREE},
skills_in_order AS (SELECT list(DISTINCT skill ORDER BY skill) AS all_skills FROM (SELECT unnest(skills) AS skill FROM postings)),
own AS (SELECT job_id, list(feature) AS have FROM features GROUP BY job_id),
pairs AS (
  SELECT job_id, have, unnest(candidates) AS skill, unnest(range(1, len(candidates) + 1)) AS pos FROM (
    SELECT p.job_id, have, [s FOR s IN all_skills IF NOT list_contains(p.skills, s)][1:15] AS candidates
    FROM postings p JOIN own USING (job_id), skills_in_order)
),
both_ways AS (
  SELECT job_id, skill, pos, have, list_append(have, skill) AS more FROM pairs
),
sides AS (
  SELECT *, list_contains(have, f1) AS a, list_contains(more, f1) AS b FROM both_ways, first_split
),
scored AS (
  SELECT s.job_id AS request_id, s.skill, s.pos, lb.mean - la.mean AS boost
  FROM sides s
  JOIN second_split sa ON sa.side = s.a JOIN leaves la ON la.side = s.a AND la.second = list_contains(s.have, sa.f2)
  JOIN second_split sb ON sb.side = s.b JOIN leaves lb ON lb.side = s.b AND lb.second = list_contains(s.more, sb.f2)
),
ranked AS (
  SELECT request_id, skill, pos, CAST(round(CAST(boost AS DECIMAL(28,6)), 2) AS DOUBLE) AS boost_amount
  FROM scored WHERE boost > 500
)
SELECT request_id, CAST(row_number() OVER w AS BIGINT) AS rank, skill, boost_amount FROM ranked
WINDOW w AS (PARTITION BY request_id ORDER BY boost_amount DESC, pos)
QUALIFY row_number() OVER w <= 3"""

_ROLE_ROADMAP = f"""WITH {_SKILLS}, {_FRAMEWORKS},
        asked AS (
          SELECT job_id AS request_id, CASE experience_level WHEN 'Lead' THEN 'Builder' WHEN 'Senior' THEN 'Modeler'
            WHEN 'Mid-level' THEN 'Analyst' ELSE 'Poet' END AS role
          FROM postings
        ),
        steps AS (
          SELECT *, unnest(base_skills) AS skill, unnest(range(1, len(base_skills) + 1)) AS skill_pos FROM frameworks
        )
        SELECT request_id, role, CAST(step AS BIGINT) AS step, title, description, l.skill,
          CAST(skill_pos AS BIGINT) AS skill_pos, frequency, avg_salary
        FROM asked
        JOIN steps l ON framework = CASE WHEN role IN (SELECT framework FROM frameworks) THEN role ELSE 'Analyst' END
        LEFT JOIN skill_stats s ON s.skill = l.skill"""

ORACLES: dict[str, str] = {
    "clean_postings": f"WITH {_CLEAN} SELECT {_FLAT} FROM postings",
    "clean_text_salary": f"""WITH {_CLEAN} SELECT {_FLAT} FROM postings
        WHERE NOT (job_title = 'BUILDING' AND industry = 'ASIA')""",
    "rejected_postings": f"""WITH {_RAW} SELECT {_FLAT} FROM raw
        WHERE job_title IS NULL OR salary IS NULL OR isnan(salary) OR skills IS NULL""",
    "overall_stats": f"WITH {_CLEAN} {_OVERALL}",
    "salary_by_title_exp": f"WITH {_CLEAN} {_BY_TITLE}",
    "skills_analysis": f"WITH {_SKILLS} SELECT * FROM skill_stats",
    "industry_metrics": f"WITH {_CLEAN} {_BY_INDUSTRY}",
    "salary_distribution": f"WITH {_CLEAN} {_BY_BAND}",
    "salary_distribution_filled": f"""WITH {_CLEAN},
        bands AS (SELECT unnest({_WIDE_LABELS}) AS label, unnest([0, 60000, 120000, 240000, 600000, 900000]) AS low,
          unnest([60000, 120000, 240000, 600000, 900000, 'inf'::DOUBLE]) AS high)
        SELECT label AS salary_band, count(job_title) AS "count"
        FROM bands LEFT JOIN postings ON salary >= low AND salary < high GROUP BY label""",
    "salary_bands": f"WITH {_CLEAN} SELECT job_id, {_BAND} AS salary_band FROM postings",
    "top_skills": f"WITH {_SKILLS} SELECT * FROM skill_stats ORDER BY frequency DESC, skill LIMIT 15",
    "market_results": f"""WITH {_SKILLS}, overall AS ({_OVERALL}), titles AS ({_BY_TITLE}),
        industries AS ({_BY_INDUSTRY}), bands AS ({_BY_BAND})
        SELECT 'overall_stats' AS result, NULL AS key, NULL AS key2, total_jobs AS n, average_salary AS mean,
          remote_percentage AS remote FROM overall
        UNION ALL SELECT 'salary_by_title_exp', job_title, experience_level, job_count, avg_salary, NULL FROM titles
        UNION ALL SELECT 'skills_analysis', skill, NULL, frequency, avg_salary, NULL FROM skill_stats
        UNION ALL SELECT 'industry_metrics', industry, NULL, job_count, avg_salary, remote_percentage FROM industries
        UNION ALL SELECT 'salary_distribution', salary_band, NULL, "count", NULL, NULL FROM bands""",
    "insights_skills": f"WITH {_SKILLS} SELECT * FROM skill_stats ORDER BY frequency DESC, skill LIMIT 15",
    "republished_industries": f"WITH {_CLEAN} {_BY_INDUSTRY}",
    "market_by_batches": f"WITH {_CLEAN} {_BY_INDUSTRY}",
    "median_by_title_exp": f"""WITH {_CLEAN} SELECT job_title, experience_level, round(median(salary), 4) AS median_salary,
        count(*) AS n FROM postings GROUP BY ALL""",
    "median_by_skill": f"""WITH {_CLEAN}, each AS (SELECT unnest(skills) AS skill, salary FROM postings)
        SELECT skill, round(median(salary), 4) AS median_salary, count(*) AS n FROM each GROUP BY skill""",
    "odd_medians": f"""WITH {_ODD} SELECT experience_level, round(median(salary), 5) AS median, count(*) AS n
        FROM postings GROUP BY experience_level""",
    "json_round_trip": f"WITH {_CLEAN} SELECT {_FLAT} FROM postings",
    "training_extract": f"""WITH {_CLEAN} SELECT job_title, location, experience_level, job_type, salary,
        array_to_string(skills, ',') AS skills, industry, demand_score FROM postings""",
    "search_all": _SEARCH.format("true"),
    "search_title": _SEARCH.format("contains(lower(job_title), 'uild')"),
    "search_title_literal": _SEARCH.format("contains(lower(job_title), '%')"),
    "search_title_industry_type": _SEARCH.format(
        "contains(lower(job_title), 'mach') AND lower(industry) = 'europe' AND lower(job_type) = 'remote'"
    ),
    "demand_rule": f"WITH {_CLEAN} SELECT job_id, demand_score FROM postings",
    "skill_premium": f"WITH {_CLEAN} SELECT job_id, CAST({_premium('skills')} AS BIGINT) AS skill_premium FROM postings",
    "expected_salary": f"WITH {_CLEAN} SELECT job_id, {_pay('skills')} AS expected_salary FROM postings",
    "parse_skill_list": f"WITH {_USERS} SELECT user_id, array_to_string(own, '|') AS skills FROM parsed",
    "skill_roadmap": f"""WITH {_USERS},
        steps AS (
          SELECT user_id, skill, avg_salary,
            row_number() OVER (PARTITION BY user_id ORDER BY frequency DESC, skill) AS step
          FROM parsed, skill_stats WHERE len(own) > 0 AND NOT list_contains(own, skill)
        )
        SELECT user_id, CAST(step AS BIGINT) AS step, skill, avg_salary AS target_avg_salary,
          'Expands market capability, average salary is $' || format('{{:,.2f}}', avg_salary) || '.' AS reason,
          CASE WHEN avg_salary > 250000 THEN 'High' ELSE 'Medium' END AS priority
        FROM steps WHERE step <= 5""",
    "role_roadmap": _ROLE_ROADMAP,
    "nested_role_roadmap": f"""WITH long AS ({_ROLE_ROADMAP}) SELECT request_id, role, step, title, description,
        string_agg(skill, ',' ORDER BY skill_pos) AS skills FROM long GROUP BY ALL""",
    "what_if_rule": _what_if("skill"),
    "what_if_rule_by_profile": _what_if("skill"),
    "what_if_rule_by_importance": _what_if("avg_salary DESC, skill"),
    "regression_report": f"""WITH {_CLEAN}, paid AS (SELECT salary AS y, {_pay('skills')} AS p FROM postings)
        SELECT count(*) AS n, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
          round(avg(abs(y - p)), 6) AS mae FROM paid""",
    "accuracy": f"""WITH {_CLEAN} SELECT count(*) AS n,
        round(avg(CASE WHEN demand_score = other_demand THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM postings""",
    "classification_report": _PER_CLASS,
    "category_values": f"WITH {_VALUES} SELECT field, value FROM found",
    "category_lists": f"""WITH {_VALUES} SELECT field, string_agg(value, ',' ORDER BY value) AS "values"
        FROM found GROUP BY field""",
    "features_long": f"WITH {_FEATURES} SELECT job_id, feature, CAST(1 AS DOUBLE) AS value FROM features",
    "train_test_split": f"""WITH {_CLEAN} SELECT job_id,
        CASE WHEN CAST('0x' || substr(md5(job_id), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split
        FROM postings""",
    "demand_codes": f"""WITH {_CLEAN}, coded AS (
          SELECT job_id, demand_score, CASE demand_score WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS code
          FROM postings)
        SELECT job_id, CAST(code AS DOUBLE) AS demand_code, demand_score AS decoded FROM coded""",
    "forest_facts": f"""WITH {_FEATURES} SELECT count(DISTINCT p.job_id) AS requests, count(DISTINCT p.job_id) AS answered,
        (SELECT count(DISTINCT feature) FROM features) AS features, CAST(1 AS DOUBLE) AS importance_sum, true AS good_fit
        FROM postings p""",
    "tree_predictions": f"""WITH {_TREE} SELECT s.job_id AS request_id,
        CAST(round(CAST(mean AS DECIMAL(28,6)), 2) AS DOUBLE) AS predicted_salary
        FROM sided s JOIN second_split t USING (side)
        JOIN leaves l ON l.side = s.side
          AND l.second = (s.job_id IN (SELECT job_id FROM features f WHERE f.feature = t.f2))""",
    "tree_node_predictions": f"""WITH {_TREE} SELECT s.job_id AS request_id,
        CAST(round(CAST(mean AS DECIMAL(28,6)), 2) AS DOUBLE) AS predicted_salary
        FROM sided s JOIN second_split t USING (side)
        JOIN leaves l ON l.side = s.side
          AND l.second = (s.job_id IN (SELECT job_id FROM features f WHERE f.feature = t.f2))""",
    "tree_importances": f"WITH {_TREE} SELECT feature, importance FROM importances",
    "tree_top_features": f"""WITH {_TREE} SELECT feature, importance FROM importances
        ORDER BY importance DESC, feature LIMIT 2""",
    "tree_what_if": _TREE_WHAT_IF,
    "tree_what_if_walk": _TREE_WHAT_IF,
    "tree_leaf_paths": f"""WITH {_TREE},
        tests AS (
          SELECT side, second, mean, CASE WHEN side THEN [f1] ELSE [] END || CASE WHEN second THEN [f2] ELSE [] END AS yes,
            CASE WHEN side THEN [] ELSE [f1] END || CASE WHEN second THEN [] ELSE [f2] END AS no
          FROM leaves JOIN second_split USING (side), first_split
        )
        SELECT array_to_string(list_sort(yes), ',') AS required, array_to_string(list_sort(no), ',') AS forbidden,
          round(mean, 6) AS value FROM tests""",
    "bagged_predictions": f"WITH {_BAGGED}",
    "bagged_node_predictions": f"WITH {_BAGGED}",
    "forest_nodes_agree": f"WITH {_CLEAN} SELECT job_id AS request_id, true AS same FROM postings",
    "recorded_metadata": f"WITH {_VALUES} SELECT field, value FROM found",
    "skill_roadmap_repeats": f"""WITH {_SKILLS},
        known AS (SELECT DISTINCT customer, skill FROM (SELECT customer, unnest(skills) AS skill FROM postings)),
        few AS (
          SELECT customer AS user_id, list(skill) AS own FROM known
          WHERE CAST('0x' || substr(md5(customer || '/' || skill), 1, 4) AS INT) % 3 = 0 GROUP BY customer
        ),
        steps AS (
          SELECT user_id, skill, avg_salary,
            row_number() OVER (PARTITION BY user_id ORDER BY frequency DESC, skill) AS step
          FROM few, skill_stats WHERE NOT list_contains(own, skill)
        )
        SELECT user_id, CAST(step AS BIGINT) AS step, skill, avg_salary AS target_avg_salary,
          'Expands market capability, average salary is $' || format('{{:,.2f}}', avg_salary) || '.' AS reason,
          CASE WHEN avg_salary > 250000 THEN 'High' ELSE 'Medium' END AS priority
        FROM steps WHERE step <= 5""",
    "answers_rule": f"""WITH boosts AS ({_what_if("skill")}),
        listed AS (SELECT request_id, string_agg(skill || ':' || boost_amount, '|' ORDER BY rank) AS boosts FROM boosts GROUP BY 1),
        {_CLEAN}
        SELECT job_id AS request_id, {_pay("skills")} AS predicted_salary, demand_score, coalesce(boosts, '') AS boosts
        FROM postings LEFT JOIN listed ON job_id = request_id""",
    "array_round_trip": f"WITH {_CLEAN} SELECT {_FLAT} FROM postings",
    "any_array_round_trip": f"""WITH {_CLEAN}, named AS (SELECT * REPLACE ('}} "{{\\" ][' || company AS company) FROM postings)
        SELECT {_FLAT} FROM named""",
    "parquet_round_trip": f"WITH {_CLEAN} SELECT {_FLAT} FROM postings",
    "expected_salary_table": f"WITH {_CLEAN} SELECT job_id, {_pay('skills')} AS expected_salary FROM postings",
    "odd_clean": f"WITH {_ODD} SELECT {_FLAT} FROM postings",
    "odd_overall_stats": f"WITH {_ODD} {_OVERALL}",
    "odd_salary_by_title_exp": f"WITH {_ODD} {_BY_TITLE}",
    "odd_skills_analysis": f"WITH {_ODD_SKILLS} SELECT * FROM skill_stats",
    "odd_industry_metrics": f"WITH {_ODD} {_BY_INDUSTRY}",
    "odd_salary_distribution": f"WITH {_ODD} {_BY_BAND}",
    "odd_pay": f"""WITH {_ODD} SELECT job_id, job_title, {_ODD_PAY} AS expected_salary,
        CAST({_premium('skills')} AS BIGINT) AS skill_premium FROM postings""",
    "odd_search_percent": f"""WITH {_ODD} SELECT {_FLAT} FROM odd WHERE contains(lower(job_title), '0% b')
        ORDER BY job_id LIMIT 40""",
    "odd_accuracy": f"""WITH {_ODD} SELECT count(*) AS n,
        round(avg(CASE WHEN experience_level IS NOT NULL AND demand_score = other_demand THEN 1.0 ELSE 0.0 END), 6)
          AS accuracy FROM postings""",
    "odd_classification_report": _ODD_REPORT,
}

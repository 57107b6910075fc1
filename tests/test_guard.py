"""Readers' SQL: what passes the guard, and what does not."""

import pytest

from monthmill.plans import guard


TYPED = """CREATE TABLE gold.typed USING parquet AS SELECT id, CAST(id AS STRING) AS s, DATE'2020-01-01' AS d, TIMESTAMP'2020-01-01 10:00:00' AS t,
  array(id, 2) AS a, map('a', id) AS m, CAST(id AS DECIMAL(10, 2)) AS q, named_struct('x', id) AS st FROM range(10)"""


@pytest.fixture(scope="module")
def schemas(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.range(5).createOrReplaceTempView("loose")
    spark.sql("DROP TABLE IF EXISTS gold.numbers")
    spark.range(5).write.mode("overwrite").saveAsTable("gold.numbers")
    spark.sql("DROP TABLE IF EXISTS hidden")
    spark.range(3).write.mode("overwrite").saveAsTable("hidden")
    spark.sql("SELECT 1 AS id").createOrReplaceTempView("numbers")
    spark.sql("CREATE OR REPLACE VIEW gold.even AS SELECT id FROM gold.numbers WHERE id % 2 = 0")
    spark.sql("DROP TABLE IF EXISTS gold.typed")
    spark.sql(TYPED)
    yield {"gold"}
    spark.catalog.dropTempView("numbers")
    spark.sql("DROP VIEW gold.even")
    for name in ("gold.numbers", "gold.typed", "hidden"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql("DROP DATABASE gold")


ACCEPTED = ["SELECT * FROM gold.numbers", "WITH x AS (SELECT id FROM gold.numbers) SELECT a.id FROM x a JOIN gold.numbers b USING (id)", "SELECT id, count(*) FROM gold.numbers GROUP BY id HAVING count(*) > 0 ORDER BY 1 LIMIT 2", "SELECT (SELECT max(id) FROM gold.numbers) m", "SELECT id FROM gold.numbers UNION SELECT id FROM gold.numbers"]
REJECTED = [
    "", "INSERT INTO gold.numbers VALUES (1)", "DROP TABLE gold.numbers", "CREATE TABLE gold.x AS SELECT 1", "DELETE FROM gold.numbers", "UPDATE gold.numbers SET id = 1", "TRUNCATE TABLE gold.numbers", "ALTER TABLE gold.numbers RENAME TO gold.y", "USE gold", "SET x = 1", "SHOW TABLES", "SELECT 1; SELECT 2",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.name') FROM gold.numbers", "SELECT java_method('java.lang.System', 'lineSeparator') FROM gold.numbers", "SELECT id FROM gold.numbers WHERE upper(try_reflect('java.lang.System', 'lineSeparator')) = ''", "SELECT max(input_file_name()) FROM gold.numbers GROUP BY id HAVING count(*) > 0 ORDER BY reflect('a', 'b')", "SELECT transform(array(id), x -> reflect('a', x)) FROM gold.numbers", "SELECT (SELECT reflect('a', 'b') FROM gold.numbers) m", "WITH x AS (SELECT reflect('a', 'b') FROM gold.numbers) SELECT * FROM x", "SELECT * FROM gold.numbers LATERAL VIEW stack(2, 1, 2) t AS c",
    "SELECT * FROM loose", "SELECT * FROM raw.games", "SELECT * FROM parquet.`/etc`", "SELECT * FROM gold.numbers WHERE id IN (SELECT id FROM other.t)", "WITH x AS (SELECT * FROM other.t) SELECT * FROM x", "SELECT * FROM range(5)",
]

#: What a computed name, a name of another scope, or a short query for a very large value got past a check of names alone.
ATTACKS = [
    "select identifier('reflect')('java.lang.System','getProperty','user.name') from gold.numbers",
    "select identifier('ref'||'lect')('java.lang.System','getProperty','user.name') from gold.numbers",
    "select identifier('java_'||'method')('java.lang.System','lineSeparator') from gold.numbers",
    "select * from identifier('hidden')",
    "select identifier('id') from gold.numbers",
    "select * from hidden, (with hidden as (select 1 a) select * from hidden) q",
    "with q as (with hidden as (select 1 a) select * from hidden) select * from q, hidden",
    "with a as (select * from b), b as (select 1 x) select * from a",
    "select id from gold.numbers where exists (with hidden as (select 1 a) select * from hidden) and id in (select id from hidden)",
    "select * from numbers",
    "select * from default.hidden",
    "select * from spark_catalog.gold.numbers",
    "select user from gold.numbers",
    "select current_user() from gold.numbers",
    "select session_user from gold.numbers",
    "select current_catalog from gold.numbers",
    "select repeat('a', 2000000000)",
    "select repeat(repeat('a', 100000), 100000)",
    "select repeat('a', cast(1e9 as int))",
    "select repeat('a', 1000 * 1000 * 1000)",
    "select repeat(s, cast(s as int)) from gold.typed",
    "select sequence(1, 1000000000)",
    "select sequence(1, id) from gold.numbers",
    "select transform(sequence(1, 100000), x -> sequence(1, 100000))",
    "select replace(repeat('a', 100000), 'a', repeat('b', 100000))",
    "select lpad('a', 2000000000, 'b')",
    "select * from values (repeat('a', 2000000000)) v(a)",
    "select id from gold.numbers limit length(repeat('a', 2000000000))",
    "select * from (select id, 'x' s from gold.numbers) pivot (sum(id) for s in (repeat('a', 2000000000)))",
    "select repeat('a')",
    "select count(*) from gold.numbers tablesample (50 percent), range(10)",
    "select * from gold.numbers version as of 1",
    "select raise_error('x') from gold.numbers",
    "select hash(id), uuid(), rand() from gold.numbers",
]
READ = [
    "select sum(id) + 1, avg(q), count(distinct s), s from gold.typed where id in (1, 2, 3) and s like 'a%' or id between 2 and 5 group by s having count(*) > 1 order by 1 desc limit 3",
    "select a[0], m['a'], st.x, transform(a, x -> x + 1), filter(a, x -> x > 1), try_cast(s as int), s || 'a', right(s, 2), left(s, 2), date_add(d, 1), d + interval 1 month, t - t, d - d, extract(year from d), date_trunc('month', t), -id, case when id > 1 then 'a' else 'b' end from gold.typed",
    "select row_number() over (partition by s order by id desc nulls last), lag(id) over (order by id), sum(id) over (order by id rows between 2 preceding and current row), percent_rank() over (order by id) from gold.typed",
    "with x as (select id from gold.typed) select * from x where exists (select 1 from gold.typed b where b.id = x.id) and id not in (select id from gold.typed where id > 3) and id > (select avg(id) from gold.typed)",
    "select s, grouping(s), grouping_id(), sum(id), median(id), max_by(id, s), any_value(s), percentile_approx(id, 0.5) from gold.typed group by grouping sets ((s), ())",
    "select * from (select s, id from gold.typed) pivot (sum(id) for s in ('1', '2'))",
    "select * from gold.typed lateral view explode(a) e as z",
    "select hour(t), minute(t), second(t), ceil(q), floor(q, 1), contains(s, 'a'), startswith(s, 'a'), rpad(s, 9, '-'), to_timestamp(s), date_part('year', d), try_divide(id, 0), id div 2, id % 2, log(id), regexp_replace(s, 'a', 'b'), sequence(date'2020-01-01', date'2020-02-01'), sequence(1, 9, 2), repeat(s, 3), unix_timestamp(t) from gold.typed",
    "with recursive_free as (select id from gold.typed), two as (select * from recursive_free) select * from two join gold.typed using (id)",
]


@pytest.mark.parametrize("sql", READ)
def test_guard_lets_readers_read(spark, schemas, sql):
    assert guard.check_sql(spark, sql, schemas) == ["gold.typed"]
    assert guard.guarded_sql(spark, sql, schemas, 5).count() <= 5


def test_a_view_is_a_table_of_its_schema(spark, schemas):
    assert guard.check_sql(spark, "select * from gold.even a join gold.numbers b using (id)", schemas) == ["gold.even", "gold.numbers"]


@pytest.mark.parametrize("sql", ACCEPTED)
def test_guard_accepts(spark, schemas, sql):
    assert guard.check_sql(spark, sql, schemas) == ["gold.numbers"]
    rows = guard.guarded_sql(spark, sql, schemas, 2).collect()
    assert len(rows) <= 2 and all(isinstance(r.truncated, bool) for r in rows)


@pytest.mark.parametrize("sql", REJECTED + ATTACKS)
def test_guard_rejects(spark, schemas, sql):
    with pytest.raises(guard.SqlRejected):
        guard.check_sql(spark, sql, schemas)


def test_catalog(spark, schemas):
    assert sorted(t[0] for t in guard.list_tables(spark, "gold")) == ["even", "numbers", "typed"]
    types, sample = guard.describe(spark.table("gold.numbers"), 3)
    assert types == [("id", "bigint")] and sample.count() == 3

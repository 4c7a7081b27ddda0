-- what a copy of the sf0.001 tables must satisfy, in the session that made it

-- ASSERT: orders arrived whole
SELECT count(*) = (SELECT count(*) FROM parquet.`/root/testdata/sf0.001/orders.parquet`) FROM spark_catalog.shop_copy.orders

-- ASSERT: every customer has a key
SELECT bool_and(c_custkey IS NOT NULL) FROM spark_catalog.shop_copy.customer

-- ASSERT: order keys are unique
SELECT count(DISTINCT o_orderkey) = count(*) FROM spark_catalog.shop_copy.orders

SELECT c_nationkey, count(*) AS customers FROM spark_catalog.shop_copy.customer GROUP BY c_nationkey ORDER BY c_nationkey

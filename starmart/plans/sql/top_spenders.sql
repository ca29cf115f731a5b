-- Spend is totalled per user id first, so the users join a row per buyer, not per sale. Prices
-- that six places hold without loss are summed as decimals, the others as doubles.
WITH prices AS (
    SELECT
        product_id,
        CAST(price AS DOUBLE) AS price,
        TRY_CAST(price AS DECIMAL(18, 6)) AS exact_price,
        CAST(TRY_CAST(price AS DECIMAL(18, 6)) AS DOUBLE) <=> CAST(price AS DOUBLE) AS is_exact
    FROM products
),

spend AS (
    SELECT
        user_id,
        SUM(CASE WHEN is_exact THEN quantity * exact_price END) AS amount,
        SUM(CASE WHEN NOT is_exact THEN quantity * price END) AS odd_amount
    FROM transactions
    INNER JOIN prices USING (product_id)
    GROUP BY user_id
)

SELECT
    user_id,
    users.name,
    COALESCE(
        CAST(SUM(amount) AS DOUBLE) + SUM(odd_amount), CAST(SUM(amount) AS DOUBLE), SUM(odd_amount)
    ) AS total_spent
FROM spend
INNER JOIN users USING (user_id)
GROUP BY user_id, users.name
ORDER BY total_spent DESC, user_id ASC
LIMIT 10

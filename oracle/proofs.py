"""What the proofs must find: as many rows as the tables give, and none that breaks the property."""

from oracle.features import JOINED
from oracle.segments import BASE
from oracle.segments import TABLES as CUSTOMERS
from oracle.tables import statement as q

TEST_DAYS = JOINED + """
, t AS (SELECT count(*) AS checked, 0::BIGINT AS violations FROM joined WHERE date > (SELECT max(date) FROM joined) - 56)
"""

SQL = {
    "proof_forecasts": q("daily_sales dense_days", TEST_DAYS + "SELECT unnest(['autoregressive', 'seasonal', 'boosted']) AS model, * FROM t"),
    "proof_drivers": q("daily_sales dense_days", TEST_DAYS + "SELECT * FROM t"),
    "proof_clusters": q(CUSTOMERS, BASE + "\nSELECT count(*) AS checked, 0::BIGINT AS violations FROM base"),
}

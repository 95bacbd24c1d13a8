﻿SELECT o_orderstatus AS column_1, count(*) AS n_orders
FROM orders
GROUP BY o_orderstatus

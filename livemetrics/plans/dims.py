"""Room dimension lookup (D1): room -> owner, group and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.sources.tables import valid_rooms

def room_dims(rooms: DataFrame, categories: DataFrame) -> DataFrame:
    """Valid rooms (room_id > 0) with their category: room_id, rdomain, user_id, user_title,
    cid, cname, cdomain.  Nothing is broadcast by hand: both joins are left to AQE, which
    broadcasts a side once its measured bytes are under the session's threshold."""
    r = valid_rooms(rooms).select("room_id", F.col("domain").alias("rdomain"), "user_id", "user_title",
                                  "category_id")
    c = categories.select(F.col("id").alias("cid"), F.col("name").alias("cname"), F.col("domain").alias("cdomain"))
    return r.join(c, r.category_id == c.cid, "left").drop("category_id")

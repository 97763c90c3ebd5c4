"""DuckDB text for the oracle check.

``VIOLATIONS`` and ``DETECTIONS`` are the FIXTURES §C/§D adapters in DuckDB
dialect; every oracle query starts from them through ``with_views``. Spark
and DuckDB differ in a few places (see SURVEY §5), handled here:
``trunc`` before int casts, ``dayofweek + 1``, ``sum`` cast to BIGINT,
explicit null ordering, and floats rounded to 6 places on both sides.
"""

from __future__ import annotations

VIOLATIONS = """
SELECT 'V' || CAST(event_id AS VARCHAR) AS Violation_ID,
  CASE WHEN event_id % 25 = 0 THEN '32/13/2025'
       WHEN event_id % 25 = 1 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
       WHEN event_id % 25 = 2 THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS Timestamp,
  CASE WHEN event_id % 50 = 3 THEN 'unknown' WHEN event_id % 50 = 13 THEN '1e300,2'
       WHEN event_id % 50 = 23 THEN 'NaN,5' WHEN event_id % 50 = 33 THEN '7,Infinity'
       ELSE CAST((user_id * user_id * 7) % 179 - 89 AS VARCHAR) || '.' || lpad(CAST((user_id * 7919) % 10000 AS VARCHAR), 4, '0')
            || ',' || CAST((user_id * 53) % 359 - 179 AS VARCHAR) || '.' || lpad(CAST((user_id * 104729) % 10000 AS VARCHAR), 4, '0') END AS Location,
  CASE WHEN event_id % 20 = 5 THEN NULL WHEN event_type = 'click' THEN ' Speeding' WHEN event_type = 'error' THEN 'Red Light '
       WHEN event_type = 'purchase' THEN 'No Helmet' WHEN event_type = 'signup' THEN 'Parking' ELSE 'Seat Belt' END AS Violation_Type,
  CASE user_id % 5 WHEN 0 THEN 'Car' WHEN 1 THEN 'Bike' WHEN 2 THEN 'Truck' WHEN 3 THEN 'Bus' ELSE 'Auto' END AS Vehicle_Type,
  CASE WHEN value < 10 THEN 'Low' WHEN value < 40 THEN 'Medium' ELSE 'High' END AS Severity,
  CASE event_id % 3 WHEN 0 THEN 'abc' WHEN 1 THEN NULL ELSE CAST(100 + (event_id * 13) % 1901 AS VARCHAR) END AS Fine_Amount
FROM events
"""

DETECTIONS = """
WITH e AS (SELECT event_id, event_id // 2100 AS part, (event_id // 2100) % 3 = 1 AS crowd, event_id // 6300 AS stretch FROM events),
f AS (SELECT CASE WHEN crowd THEN 1000000000 + stretch // 4096 ELSE part END AS video_id, event_id, crowd,
  (event_id // 7) % 300 + CASE WHEN crowd THEN stretch % 4096 * 300 ELSE 0 END AS frame_id, event_id % 7 AS slot
  FROM e WHERE (event_id % 1000) * 7919 % 20 <> 0),
b AS (SELECT video_id, event_id, frame_id, slot,
  CASE WHEN slot IN (2, 3, 4, 5) THEN 400 + frame_id * 6 + (event_id % 4) * 30
       WHEN crowd AND slot = 0 THEN 900 + frame_id * 6 + frame_id * 5 % 37
       WHEN crowd AND slot = 1 THEN 910 + frame_id * 6 + frame_id * 7 % 41
       WHEN slot = 0 THEN 870 + frame_id * 14 WHEN slot = 1 THEN 400 + frame_id * 6 ELSE 900 + frame_id * 6 END AS x,
  CASE WHEN slot IN (2, 3, 4, 5) THEN 90 WHEN slot = 6 THEN 160 WHEN slot = 0 THEN 165 WHEN crowd THEN 150 ELSE 100 END AS y,
  CASE WHEN slot IN (2, 3, 4) THEN 30 WHEN slot = 5 THEN 12 WHEN slot = 6 THEN 140 ELSE 80 END AS w,
  CASE WHEN slot = 5 THEN 12 ELSE 60 END AS h FROM f)
SELECT CAST(video_id AS BIGINT) AS video_id, frame_id, CAST(slot AS INT) AS det_id,
  CASE slot WHEN 0 THEN 'car' WHEN 1 THEN 'motorcycle' WHEN 5 THEN 'helmet' WHEN 6 THEN 'truck' ELSE 'person' END AS class_name,
  CAST(30 + event_id % 70 AS DOUBLE) / 100 AS conf,
  CAST(x AS INT) AS x1, CAST(y AS INT) AS y1, CAST(x + w AS INT) AS x2, CAST(y + h AS INT) AS y2
FROM b
"""


def with_views(body: str, **views: str) -> str:
    """Prefix ``body`` with ``WITH name AS (...)`` for each view, in order."""
    ctes = ",\n".join(f"{name} AS ({text.strip()})" for name, text in views.items())
    return f"WITH {ctes}\n{body.strip()}"

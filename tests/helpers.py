"""Hand-written shot rows (FIXTURES.md section 4) and small comparison helpers."""

from shotframe.schema import RAW_SHOT_SCHEMA


def shot(**kw):
    base = {f.name: None for f in RAW_SHOT_SCHEMA.fields}
    base.update({"SEASON_1": 2020, "PLAYER_ID": 1, "PLAYER_NAME": "A", "GAME_ID": 1,
                 "GAME_DATE": "04-10-2020", "SHOT_MADE": True, "ACTION_TYPE": "Jump Shot",
                 "SHOT_TYPE": "2PT Field Goal", "BASIC_ZONE": "Mid-Range",
                 "ZONE_RANGE": "16-24 ft.", "LOC_X": 0.0, "LOC_Y": 100.0, "SHOT_DISTANCE": 18,
                 "QUARTER": 1, "MINS_LEFT": 5, "SECS_LEFT": 0})
    base.update(kw)
    return tuple(base[f.name] for f in RAW_SHOT_SCHEMA.fields)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SHOT_SCHEMA)


def as_dicts(df, order=None):
    rows = df.collect()
    out = [r.asDict() for r in rows]
    if order:
        out.sort(key=lambda d: tuple((d[k] is None, d[k]) for k in order))
    return out

import datetime as dt

from clickscope.schemas import USER_VISIT_ACTION

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def action(session_id, seconds, event_id, user_id=1, page_id=1, keyword=None, click=None, click_product=None,
           order=None, pay=None, city_id=0, date="2024-01-01"):
    return (date, user_id, session_id, page_id, T0 + dt.timedelta(seconds=seconds), keyword, click, click_product,
            order, None, pay, None, city_id, event_id)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, USER_VISIT_ACTION)


def rows_set(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

"""Property tests: arbitrary text never breaks the cleaner; kept + rejected = all."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.operators import silver
from tillroll.schemas import RAW_COLUMNS

from helpers import bronze_df

cell = st.one_of(
    st.none(),
    st.text(max_size=12),
    st.from_regex(r"-?[0-9]{1,12}(\.[0-9]{1,5})?", fullmatch=True),
    st.from_regex(r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,5} [0-9]{1,2}:[0-9]{2}", fullmatch=True),
    st.from_regex(r"[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?", fullmatch=True),
)
rows = st.lists(st.tuples(*[cell] * len(RAW_COLUMNS)), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_random_text_never_raises_under_ansi(spark, data):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    df = bronze_df(spark, data)
    checked = silver.with_reject_reason(df)
    total = checked.count()
    kept = silver.clean(df).count()
    flagged = checked.where("reject_reason IS NULL").count()
    assert total == len(data)
    assert kept == flagged

"""Property: the closed-form sell-through equals a week-by-week loop with back-orders."""
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.operators import engine as eng

weeks = st.integers(min_value=1, max_value=10)


@st.composite
def listing(draw):
    n = draw(weeks)
    demand = draw(st.lists(st.integers(0, 9), min_size=n, max_size=n))
    steps = draw(st.lists(st.integers(0, 12), min_size=n, max_size=n))
    supply, acc = [], 0
    for s in steps:          # a monotone cumulative supply schedule
        acc += s
        supply.append(float(acc))
    return demand, supply


def loop(demand, supply):
    sold, out = 0, []
    cum = 0
    for d, s in zip(demand, supply):
        cum += d
        x = max(min(s - sold, cum - sold), 0)   # serve backlog + this week's demand from what has arrived
        sold += x
        out.append((int(x), int(round(s - sold)), cum - sold))
    return out


@settings(max_examples=25, deadline=None)
@given(listing())
def test_closed_form_equals_loop(spark, case):
    demand, supply = case
    rows = [("L", "S", w + 1, d, s) for w, (d, s) in enumerate(zip(demand, supply))]
    df = spark.createDataFrame(rows, "location_id string, sku_id string, week_id int, demand_units long, s_t double")
    got = [(r.realized_sales, r.on_hand_units, r.unmet_cum_demand)
           for r in eng.sell_through(df).orderBy("week_id").collect()]
    assert got == [(a, b, float(c)) for a, b, c in loop(demand, supply)]

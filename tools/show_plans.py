"""Print the physical plan trees of the key operators (no run)."""
import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tripforge.session import build_session  # noqa: E402
from tripforge.plans import registry  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = build_session("local[8]", shuffle_partitions=16)
qs = registry.queries()
for name in ["poi_radius_counts", "seasonal_weather", "recommend_top_n", "hotel_price_stats", "geocode_gazetteer"]:
    df = qs[name](spark, SF)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    details = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
    print(f"### {name}\n\n```\n{tree}\n" + "\n".join(details[:6]) + "\n```\n")

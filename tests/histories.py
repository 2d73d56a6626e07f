"""Request histories of single ids: (arrival_ms, scheduled_at), what fires and what goes stale."""

CASES = {
    "single": ([(0, 50_000)], [50_000], {}),
    "reschedule later": ([(0, 50_000), (10_000, 80_000)], [80_000], {50_000: 80_000}),
    "reschedule earlier": ([(0, 80_000), (10_000, 50_000)], [50_000], {80_000: None}),
    "same time twice": ([(0, 50_000), (10_000, 50_000)], [50_000], {}),
    "back to the first": (
        [(0, 50_000), (10_000, 80_000), (20_000, 50_000)], [50_000], {80_000: None}
    ),
    "again after firing": ([(0, 20_000), (30_000, 90_000)], [20_000, 90_000], {}),
    "arrival at fire time": ([(0, 20_000), (20_000, 60_000)], [60_000], {20_000: 60_000}),
    "past time": ([(100_000, 40_000)], [130_000], {}),
    "fallback superseded": ([(0, None), (29_000, None)], [59_000], {30_000: 59_000}),
}


def rows(cases=CASES):
    """Request rows `id, arrival_ms, seq, scheduled_at` of all cases, each case an id."""
    return [
        (name, arrival, seq, scheduled_at)
        for name, (history, _, _) in cases.items()
        for seq, (arrival, scheduled_at) in enumerate(history)
    ]


SCHEMA = "id string, arrival_ms bigint, seq bigint, scheduled_at bigint"

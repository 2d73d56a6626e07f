"""The rule played event by event: one clock, requests and timers of one id in turn.

A timer runs once the clock has passed its time, hence after requests that arrive at that very
millisecond.
"""

from __future__ import annotations


def play(history, as_of=None, delay=30_000, fixed=None):
    """`history`: (arrival_ms, seq, scheduled_at) of one id. Returns fired, stale and pending.

    `stale` maps the time of a timer that went off in vain to the time expected instead.
    """
    requests = sorted(row for row in history if as_of is None or row[0] <= as_of)
    armed, held, fired, stale = set(), None, [], {}

    def let_time_pass(until):
        nonlocal held
        for timer in sorted(t for t in armed if until is None or t < until):
            armed.discard(timer)
            if timer == held:
                fired.append(timer)
                held = None
            else:
                stale[timer] = held

    for arrival, _, scheduled_at in requests:
        let_time_pass(arrival)
        if fixed is not None:
            held = arrival + fixed
        elif scheduled_at is not None and scheduled_at > arrival:
            held = scheduled_at
        else:
            held = arrival + delay
        armed.add(held)
    let_time_pass(None if as_of is None else as_of + 1)
    return fired, stale, held

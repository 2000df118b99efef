from tidemark.streaming.pacer import Pacer


def add(p, grp, now):
    p.open(grp, now)
    p.write(b"%d" % grp)
    p.close()


def gone(p, now, **kw):
    return [g for g, _ in p.release(now, **kw)]


def test_one_group_at_a_time():
    p = Pacer()
    add(p, 0, 0)
    add(p, 1, 0)
    assert gone(p, 0) == [0] and gone(p, 5) == []
    p.take(0)
    p.deliver(0)
    assert gone(p, 9) == [] and gone(p, 10) == [1]
    assert p.wait_max == 10 and p.unpaced == 0


def test_a_group_nobody_took_counts_as_delivered():
    p = Pacer()
    add(p, 0, 0)
    add(p, 1, 0)
    assert gone(p, 0) == [0] and gone(p, 49) == [] and gone(p, 50) == [1] and p.unpaced == 0


def test_forced_at_the_cap_and_by_depth():
    p = Pacer()
    add(p, 0, 0)
    add(p, 1, 0)
    assert gone(p, 0) == [0]
    p.take(0)
    assert gone(p, 249) == [] and gone(p, 250) == [1] and p.unpaced == 1
    p.take(1)
    for g in range(2, 12):
        add(p, g, 251)
    assert gone(p, 251) == [2, 3] and p.queue_max == 10 and len(p.queue) == 8


def test_no_subscriber_no_hold_and_gathering():
    p = Pacer()
    for g in range(4):
        add(p, g, 0)
    assert gone(p, 0, subscribed=False) == [0, 1, 2, 3] and p.unpaced == 0
    p.open(4, 1)
    p.write(b"a")
    assert gone(p, 100, subscribed=False) == []
    p.write(b"b")
    assert p.drain(100) == [(4, [b"a", b"b"])]

import string

import pytest

from accrue.sources.jdbc import jdbc_options, upsert_statement

GOOD = {"host": "warehouse", "port": 5432, "user": "loader", "password": "pw", "database": "ledger"}


def url(**change):
    return jdbc_options(**{**GOOD, **change})["url"]


@pytest.mark.parametrize("port", [1, "1", 65535, "65535"])
def test_ports_at_both_ends(port):
    assert url(port=port) == f"jdbc:postgresql://warehouse:{port}/ledger"


@pytest.mark.parametrize("port", [0, 65536, -5, 1.5, "", "x", "\u0661", "1" * 6, None])
def test_other_ports_are_refused(port):
    with pytest.raises(ValueError):
        url(port=port)


@pytest.mark.parametrize("host", ["h", "h" * 253, "a.b-c_d", "10.20.30.40"])
def test_names_and_addresses_go_in_as_they_are(host):
    assert f"//{host}:5432/" in url(host=host)


@pytest.mark.parametrize("host, bracketed", [("::1", "[::1]"), ("[::1]", "[::1]"), ("fe80:0:0:0:0:0:0:7", "[fe80::7]")])
def test_ipv6_addresses_are_put_in_brackets(host, bracketed):
    assert f"//{bracketed}:5432/" in url(host=host)


@pytest.mark.parametrize("character", [c for c in string.punctuation if c in "/?#@:,[]%&;=\\'\""] + [" ", "\t", "\x00", "\x7f", "\u00fc"])
def test_a_host_cannot_leave_its_part_of_the_url(character):
    with pytest.raises(ValueError):
        url(host=f"h{character}x")


@pytest.mark.parametrize("host", ["", "h" * 254])
def test_the_length_of_a_host(host):
    with pytest.raises(ValueError):
        url(host=host)


@pytest.mark.parametrize("name", ["", "d" * 64, "two words", "d/x", "d?x", "d-x"])
def test_database_names_are_plain(name):
    assert url(database="d" * 63).endswith("/" + "d" * 63)
    with pytest.raises(ValueError):
        url(database=name)


@pytest.mark.parametrize("text", ["", *string.punctuation, "\n", "\u20ac"])
def test_passwords_may_hold_anything(text):
    assert jdbc_options(**{**GOOD, "password": f"a{text}b"})["password"] == f"a{text}b"


@pytest.mark.parametrize("field", ["host", "user", "password", "database"])
def test_everything_must_be_text(field):
    for value in (None, 7, b"x"):
        with pytest.raises(ValueError):
            jdbc_options(**{**GOOD, field: value})


def test_upsert_statement():
    statement = upsert_statement("books.lines", "incoming", ["a", "b", "c"], ["a", "b"])
    assert statement == "INSERT INTO books.lines (a, b, c) SELECT a, b, c FROM incoming ON CONFLICT (a, b) DO UPDATE SET c = EXCLUDED.c"
    for change in ({"target": "lines x"}, {"staging": "in-coming"}, {"columns": ["a", "b)"]}):
        with pytest.raises(ValueError):
            upsert_statement(**{"target": "lines", "staging": "incoming", "columns": ["a"], "keys": ["a"], **change})

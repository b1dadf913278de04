from terralane.operators.packed import split_packed, unpack_fields


def test_delimiters_quotes_and_brackets():
    assert split_packed("osm; overture") == ["osm", "overture"]
    assert split_packed(";osm;|overture;;") == ["osm", "overture"]
    assert split_packed("osm / overture / a/b") == ["osm", "overture", "a/b"]
    assert split_packed('"Harta Data, Inc."|"Dagat|Lupa Maps", x') == ["Harta Data, Inc.", "Dagat|Lupa Maps", "x"]
    assert split_packed("['osm', 'x; y']") == ["osm", "x; y"]
    assert split_packed('["a"]') == ["a"]
    assert split_packed("001\t002\n003") == ["001", "002", "003"]
    assert split_packed(r'"say \"hi\", ok";b') == ['say "hi", ok', "b"]
    assert split_packed('"a ""q"" b";c') == ['a "q" b', "c"]


def test_defined_results_of_odd_texts():
    assert split_packed(None) == split_packed("") == split_packed("  ;, ") == []
    assert split_packed("O'Brien; Sons") == ["O'Brien", "Sons"]
    assert split_packed('"open; never') == ['"open', "never"]
    assert split_packed("Foo (a, b); c") == ["Foo (a, b)", "c"]
    assert split_packed("[a; b") == ["[a", "b"]
    assert split_packed("x;x;x") == ["x"] * 3
    assert len(split_packed("ab;" * 200_000)) == 200_000


def test_unpack_fields(spark):
    df = spark.createDataFrame([(1, "a;b", None, 5), (1, "a;b", "x", 6), (None, "q", "1|2", 7)], "rec_id long, f string, g string, item_no int")
    rows = sorted((r.rec_id or 0, r.field_name, r.item_no, r.item_value) for r in unpack_fields(df, "rec_id", ["f", "g"]).collect())
    assert rows == [(0, "f", 1, "q"), (0, "g", 1, "1"), (0, "g", 2, "2"), (1, "f", 1, "a"), (1, "f", 1, "a"), (1, "f", 2, "b"), (1, "f", 2, "b"), (1, "g", 1, "x")]
    assert unpack_fields(df, "rec_id", ["f", "g"], 2).count() == 6
    assert unpack_fields(df.limit(0), "rec_id", ["f"]).count() == 0


def test_quoted_values_come_back():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    value = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs", "Cc")), min_size=1, max_size=12).map(str.strip).filter(bool)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(value, min_size=1, max_size=6), st.sampled_from([",", ";", "|", "; ", " | ", "\t", "\n", " / ", ";|"]))
    def back(values, delimiter):
        quoted = delimiter.join('"' + v.replace("\\", "\\\\").replace('"', '""') + '"' for v in values)
        assert split_packed(quoted) == values

    back()

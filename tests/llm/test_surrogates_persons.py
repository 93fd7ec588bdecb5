"""Persons keep one surrogate with and without title and given name; distinct ones stay distinct."""

import itertools

from quillwort.llm import surrogates


def replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["pii_kinds"]) for r in surrogates.replace_entities(docs, "k").collect()}


def test_one_person_with_and_without_title(spark):
    got, kinds = replaced(spark, ["Jane Doe and Mrs Jane Doe met; Mrs Doe left. Doe (Janet) wrote to Jane."])[0]
    bare, titled = got.split(" and ")[0], got.split("Mrs ")[1].split(" met")[0]
    given, surname = bare.split(" ")
    assert bare == titled and given in surrogates.GIVEN["latin", "female"] and surname not in {"Doe", "Jane"}
    assert got == f"{bare} and Mrs {bare} met; Mrs {surname} left. {surname} (Janet) wrote to Jane."
    assert kinds == ["name"] * 4


def test_persons_stay_distinct_and_the_same_across_texts(spark):
    givens, surnames = ["Ann", "Bea", "Cleo", "Dana"], [f"Sur{a}{b}" for a, b in itertools.product("abc", "xyz")]
    people = [f"{g} {s}" for g in givens for s in surnames]
    got = replaced(spark, [f"Mrs {p} spoke" for p in people] + [f"again Mrs {p}." for p in people])
    first = [got[i][0].removeprefix("Mrs ").removesuffix(" spoke") for i in range(len(people))]
    second = [got[len(people) + i][0].removeprefix("again Mrs ").removesuffix(".") for i in range(len(people))]
    assert first == second and len(set(first)) == len(people) and not set(first) & set(people)
    for i, j in itertools.combinations(range(len(people)), 2):
        assert (people[i].split()[1] == people[j].split()[1]) == (first[i].split()[1] == first[j].split()[1])


def test_many_given_names_of_one_list_and_clashing_columns(spark):
    rows = [(i, f"Mr Given{chr(97 + i // 26)}{chr(97 + i % 26)} Same here", "a", "b") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid string, _found string")
    got = surrogates.replace_entities(docs, "k")
    assert got.columns == ["doc_id", "text", "uid", "_found", "pii_kinds"]
    out = [r["text"] for r in got.collect()]
    assert len(set(out)) == 60 and len({t.split()[2] for t in out}) == 1

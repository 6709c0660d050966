"""Hand-made bronze rows (FIXTURES §5 style)."""

import datetime as dt

from reelhouse import schemas

FILM_DEFAULTS = dict(
    imdb_id="tt0", title="Film", release_date=dt.date(2001, 5, 1), production_companies="Studio A, Studio B",
    budget=100, revenue=1000, vote_average=6.5, vote_count=10, runtime=100, genres="Drama, Comedy",
    original_language="en",
)


def films(spark, rows):
    data = []
    for r in rows:
        d = {**FILM_DEFAULTS, **r}
        data.append(tuple(d[f.name] for f in schemas.TMDB_RAW.fields))
    return spark.createDataFrame(data, schemas.TMDB_RAW)


def crew(spark, rows):
    return spark.createDataFrame(rows, schemas.TITLE_CREW_RAW)


def names(spark, rows):
    return spark.createDataFrame(rows, schemas.NAME_BASICS_RAW)


def dup_world(spark):
    """``tt1`` twice (2001 and 2003, different revenue), two films sharing a title."""
    f = films(spark, [
        dict(imdb_id="tt1", title=" Alpha ", release_date=dt.date(2001, 3, 1), revenue=1000, vote_average=6.0,
             vote_count=10),
        dict(imdb_id="tt1", title="Alpha", release_date=dt.date(2003, 3, 1), revenue=1500, vote_average=7.0,
             vote_count=20),
        dict(imdb_id="tt2", title="Beta", release_date=dt.date(2002, 1, 1), revenue=500, genres="",
             production_companies=""),
        dict(imdb_id="tt3", title="Beta ", release_date=dt.date(2002, 2, 2), revenue=700, genres="Horror"),
        dict(imdb_id="tt4", title="Gamma", release_date=dt.date(2002, 2, 2), revenue=900, genres=" , Horror"),
    ])
    c = crew(spark, [("tt1", "nm1,nm2"), ("tt2", ""), ("tt3", "nm3"), ("tt9", "nm9")])
    n = names(spark, [("nm1", "Agnès Varda", "director"), ("nm3", "Cher", "director")])
    return f, c, n

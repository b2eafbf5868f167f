"""Hand-made raw files in the form of the film data set."""

from __future__ import annotations

import csv
import io

from marquee import schemas as S

GENRES = "[{'id': 35, 'name': 'Comedy'}, {'id': 18, 'name': 'Drama'}]"
ARGENTINA = "{'iso_3166_1': 'AR', 'name': 'Argentina'}"
SPAIN = "{'iso_3166_1': 'ES', 'name': 'Spain'}"


def movie(**changes) -> dict:
    row = dict.fromkeys(S.MOVIE.names, "")
    row.update(
        adult="False", budget="100", genres=GENRES, id="1", original_title="Nueve reinas",
        overview="a great film", popularity="1.5", production_countries=f"[{ARGENTINA}]",
        release_date="2001-05-01", revenue="250.0", title="Nine Queens", video="False",
        vote_average="7.9", vote_count="80.0",
    )
    row.update(changes)
    return row


def write_movies(path, rows) -> str:
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(S.MOVIE.names)
        for row in rows:
            out.writerow(row if isinstance(row, list) else [row[c] for c in S.MOVIE.names])
    return str(path)


def member(name, **changes) -> str:
    row = {"cast_id": 1, "character": "X", "credit_id": "c1", "gender": None, "id": 9,
           "name": name, "order": 0, "profile_path": None}
    row.update(changes)
    return repr(row)


def credits_line(cast, crew, film_id) -> str:
    def cell(items):
        if not items:
            return "[]"
        return '"[' + ", ".join(items).replace('"', '""') + ']"'
    return f"{cell(cast)},{cell(crew)},{film_id}"


def write_lines(path, header, lines) -> str:
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def csv_line(fields) -> str:
    out = io.StringIO()
    csv.writer(out).writerow(fields)
    return out.getvalue()

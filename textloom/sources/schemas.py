"""Declared schemas of inputs and outputs. Nothing is ever inferred."""

from __future__ import annotations

COMMENT = "struct<id:string,date_created:timestamp,author:string,text:string,votes_up:int,votes_down:int>"
ARTICLE = (
    "_id string, date_scraped timestamp, date_published timestamp, type string, type_version int, authors array<string>, "
    f"tags array<string>, title string, lead string, text string, comments array<{COMMENT}>"
)
TERM = "struct<normalizedForm:string,originalForms:array<string>,score:double>"
BUZZ = "struct<buzzScore:double,opinionCount:int,opinionVotes:int,opinionTerms:array<string>>"
OPINION = f"struct<id:string,date_published:timestamp,author:string,terms:array<{TERM}>,votes_up:int,votes_down:int>"
WIKI_PAGE = "id double, title string, revision struct<text:string>"

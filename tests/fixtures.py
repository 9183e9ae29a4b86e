"""A small synthetic forum: NDJSON files with the awkward rows the jobs must survive."""

from __future__ import annotations

import json
import os

DAY = 86400
START = 1735689600  # 2025-01-01 UTC


def post(i, sub, **over):
    row = {
        "id": f"p{i}", "name": f"t3_p{i}", "subreddit": sub, "author": f"user{i % 4}", "title": f"Title {i}",
        "selftext": "", "url": f"http://x/{i}", "permalink": f"/r/{i}", "score": i, "num_comments": i % 3,
        "over_18": False, "stickied": False, "created_utc": float(START + i * DAY // 2), "edited": False,
        "link_flair_text": None, "is_self": True, "spoiler": False, "locked": False, "thumbnail": "",
    }
    return {**row, **over}


def comment(i, post_id, body, **over):
    row = {
        "comment_id": f"c{i}", "post_id": post_id, "author": f"user{i % 5}", "body": body,
        "created_utc": float(START + i * 3600), "parent_id": f"t3_{post_id}", "link_id": f"t3_{post_id}",
        "score": i - 3, "is_submitter": False,
    }
    return {**row, **over}


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as out:
        for row in rows:
            out.write((row if isinstance(row, str) else json.dumps(row, ensure_ascii=False)) + "\n")


def write_tree(root):
    """Two batches by file name; the second changes rows of the first."""
    one, two = "part-20250101_0000", "part-20250102_0000"
    write_lines(f"{root}/posts/{one}-art.ndjson", [
        post(3, "art"), post(1, "Art"), post(2, " art ", author=None, edited=1.7e9, score="12.7"),
    ])
    write_lines(f"{root}/posts/{one}-maps.ndjson", [
        post(4, "Maps", over_18=True), post(5, "Maps", over_18=None), post(6, "Lost", created_utc=None), "{broken",
    ])
    write_lines(f"{root}/posts/{two}-art.ndjson", [
        post(1, "Art", score=100, title=None), {k: v for k, v in post(7, "Art").items() if k != "locked"},
    ])
    write_lines(f"{root}/comments/{one}-p1.ndjson", [
        comment(1, "p1", "First!"), comment(2, "p1", "[deleted]"), comment(3, "p1", "[removed]", author=None),
        comment(4, "p1", None), comment(5, "p1", "ok"), comment(6, "p1", "…？？ ﬁne http://a.b/c?d"),
        comment(7, "gone", "An orphan it’s", is_submitter="Yes"),
    ] + [comment(i, "p1" if i % 2 else "p3", f"comment number {i} {'?' * (i % 3)}") for i in range(8, 40)])
    write_lines(f"{root}/comments/{two}-p1.ndjson", [comment(1, "p1", "First, edited", score=50), comment(41, None, "no post")])
    write_lines(f"{root}/subreddits/{one}-art.ndjson", [
        {"subreddit": "Art", "subscribers": 10, "public_description": "d", "created_utc": 1.0, "over18": False}])
    write_lines(f"{root}/subreddits/{two}-art.ndjson", [
        {"subreddit": "ART ", "subscribers": 11, "public_description": None, "created_utc": 1.0, "over18": False},
        {"subreddit": "Maps", "subscribers": None, "public_description": "m", "created_utc": 2.0, "over18": None}])
    write_lines(f"{root}/hot_sublists/{one}.ndjson", [
        {"subreddit": "Art", "strategy": "popular", "posts_limit": 200, "include_nsfw": False}])
    write_lines(f"{root}/hot_sublists/{two}-empty.ndjson", [])
    return root

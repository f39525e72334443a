"""Edge vectors of FIXTURES.md section 3 driven from landed JSON pages through
the platform adapters (sources -> normalisers -> reshaping -> joins)."""

import datetime as dt

from metricas.plans import landed

D = dt.date


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def fb_post(pid, created="2024-03-01T10:00:00+0000", media=None, status=None, comments=1, reactions=2, shares=None):
    p = {"id": pid, "created_time": created, "message": "m", "permalink_url": f"u/{pid}",
         "status_type": status, "comments": {"summary": {"total_count": comments}},
         "reactions": {"summary": {"total_count": reactions}}}
    if media is not None:
        p["attachments"] = {"data": [{"media_type": media}]}
    if shares is not None:
        p["shares"] = {"count": shares}
    return p


def test_facebook_ingest(spark, pages):
    pg = pages([
        ("facebook", "pg", "posts", None, None, 1, {"data": [fb_post("p1", media="photo", status="added_video"),
                                                             fb_post("p2", shares=4),
                                                             fb_post("old", created="2023-12-31T23:00:00+0000")]}),
        # p1 insights: impressions 5 then 7 on the same day (last wins), an unknown metric alone on another day
        ("facebook", "pg", "post_insights", "p1", None, 2, {"data": [
            {"name": "post_impressions", "values": [{"end_time": "2024-03-02T08:00:00+0000", "value": 5}]},
            {"name": "post_clicks", "values": [{"end_time": "2024-03-02T08:00:00+0000", "value": 2}]},
            {"name": "post_impressions", "values": [{"end_time": "2024-03-02T08:00:00+0000", "value": 7}]},
            {"name": "post_engaged_users", "values": [{"end_time": "2024-03-03T08:00:00+0000", "value": 9}]}]}),
        ("facebook", "pg", "reactions", "p1", "LIKE", 3, {"summary": {"total_count": 6}}),
        ("facebook", "pg", "reactions", "p1", "CARE", 4, {"summary": {"total_count": 99}}),
        ("facebook", "pg", "page_insights", None, None, 5, {"data": [
            {"name": "page_impressions", "values": [{"end_time": "2024-03-03T08:00:00+0000", "value": 5}]},
            {"name": "page_video_views", "values": [{"end_time": "2024-03-03T08:00:00+0000", "value": 9}]},
            {"name": "page_fans", "values": [{"end_time": "2024-03-03T08:00:00+0000", "value": 40}]}]}),
        ("facebook", "pg", "page_demographics", None, None, 6, {"data": [
            {"name": "page_fans_country", "values": [
                {"end_time": "2024-03-04T08:00:00+0000", "value": {"BO": 5}},
                {"end_time": "2024-03-10T08:00:00+0000", "value": {}},
                {"end_time": "2024-03-11T08:00:00+0000", "value": {"BO": 6, "PE": 2}}]}]}),
    ])
    out = landed.facebook(pg, "2024-06-01")
    # The 2023 post is dropped; photo + added_video -> imagen
    assert rows(out["publicaciones"], "publicacion_id", "formato") == [("p1", "imagen"), ("p2", "desconocido")]
    daily = out["metricas_publicaciones_diarias"]
    # p2 has no insight days -> no daily rows; p1 has two days
    got = rows(daily, "publicacion_id", "fecha_descarga", "impresiones", "clics_enlace", "me_gusta", "ctr")
    assert got == [("p1", D(2024, 3, 2), 7, 2, 6, 2 / 7 * 100.0), ("p1", D(2024, 3, 3), 0, 0, 6, None)]
    # K3 via W1: visualizaciones_pagina comes from impresiones, not video views
    assert rows(out["estadisticas_pagina_semanal"], "fecha_corte_semana", "visualizaciones_pagina",
                "total_seguidores") == [(D(2024, 3, 3), 5, 40)]
    # G1: the week of 03-04..03-10 ends on an empty map -> no rows; next week has two
    assert rows(out["segmentacion_seguidores_semanal"], "fecha_corte_semana", "pais", "cantidad_seguidores") == [
        (D(2024, 3, 11), "BO", 6), (D(2024, 3, 11), "PE", 2)]


def test_instagram(spark, pages):
    media = [{"id": "m1", "timestamp": "2024-02-01T23:30:00+0000", "media_type": "VIDEO", "like_count": 3,
              "comments_count": 1, "video_view_count": 0},
             {"id": "m2", "timestamp": "2024-02-02T10:00:00+0000", "media_type": "CAROUSEL_ALBUM"},
             {"id": "m3", "media_type": "IMAGE"}]
    pg = pages([
        ("instagram", "ig", "media", None, None, 1, {"data": media}),
        ("instagram", "ig", "media_insights", "m1", None, 2, {"data": [
            {"name": "reach", "values": [{"value": 11}]},
            {"name": "saved", "values": [{"value": 3}, {"value": 0}]}]}),
        ("instagram", "ig", "media_insights", "m1", None, 3, {"data": [{"name": "video_views", "values": [{"value": 8}]}]}),
        ("instagram", "ig", "account_insights", None, None, 4, {"data": [
            {"name": "reach", "values": [{"end_time": "2024-01-29T08:00:00+0000", "value": 10}]},
            {"name": "profile_views", "values": [{"end_time": "2024-01-30T08:00:00+0000", "value": {"value": 4}}]},
            {"name": "follower_count", "values": [{"end_time": "2024-01-28T08:00:00+0000", "value": 100}]}]}),
        ("instagram", "ig", "demographics", None, "country", 5, {"data": [{"breakdowns": [
            {"dimension": "Country", "values": [{"name": "BO", "value": 2}, {"name": "BO", "value": 3},
                                                 {"name": "PE", "value": {"value": 4}}]},
            {"dimension": "city", "values": [{"name": "La Paz", "value": 1}]}]}]}),
        ("instagram", "ig", "demographics", None, "age", 6, {"data": [{"values": [
            {"value": {"age": {"18-24": 7}}}]}]}),
    ])
    out = landed.instagram(pg, "2024-01-31")
    assert rows(out["publicaciones"], "publicacion_id", "formato") == [("m1", "video"), ("m2", "carousel_album")]
    # A4: saved [3, 0] -> 0; J2: video_view_count 0 falls through to insights 8; date as written
    assert rows(out["metricas_publicaciones_diarias"], "publicacion_id", "fecha_descarga", "alcance", "guardados",
                "visualizaciones", "me_gusta") == [("m1", D(2024, 2, 1), 11, 0, 8, 3), ("m2", D(2024, 2, 2), 0, 0, 0, 0)]
    # Per ISO week the latest day; 01-30 only has profile views -> zeros
    assert rows(out["estadisticas_pagina_semanal"], "fecha_corte_semana", "alcance_pagina", "total_seguidores") == [
        (D(2024, 1, 28), 0, 100), (D(2024, 1, 30), 0, 0)]
    # Repeated names summed; F4 drops the city breakdown in the country response; legacy age shape
    assert rows(out["segmentacion_seguidores_semanal"], "genero", "pais", "cantidad_seguidores") == [
        ("AGE.18-24", None, 7), (None, "BO", 5), (None, "PE", 4)]


def test_linkedin(spark, pages):
    t = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    pg = pages([
        # org A: posts completed (empty) -> nothing from ugcPosts
        ("linkedin", "A", "source_status", None, None, 1, {"source": "posts", "ok": True}),
        ("linkedin", "A", "ugcPosts", None, None, 2, {"elements": [{"id": "u1", "created": {"time": t}}]}),
        # org B: posts failed midway after one row, ugcPosts completed
        ("linkedin", "B", "posts", None, None, 3, {"elements": [
            {"urn": "urn:li:share:1", "createdAt": {"time": t}, "permalinks": ["pl1", "pl2"],
             "associatedUrn": "urn:li:activity:1"}]}),
        ("linkedin", "B", "source_status", None, None, 4, {"source": "posts", "ok": False}),
        ("linkedin", "B", "source_status", None, None, 5, {"source": "ugcPosts", "ok": True}),
        ("linkedin", "B", "ugcPosts", None, None, 6, {"elements": [
            {"id": "u2", "lastModifiedAt": {"time": t}, "specificContent": {"com.linkedin.ugc.ShareContent": {
                "shareCommentary": {"text": "hola"}, "media": [{"status": "ready"}]}}}]}),
        # org C: only shares works
        ("linkedin", "C", "source_status", None, None, 7, {"source": "posts", "ok": False}),
        ("linkedin", "C", "source_status", None, None, 8, {"source": "ugcPosts", "ok": False}),
        ("linkedin", "C", "source_status", None, None, 9, {"source": "shares", "ok": True}),
        ("linkedin", "C", "shares", None, None, 10, {"elements": [
            {"id": "123", "created": {"time": t}}, {"id": "abc", "created": {"time": t}},
            {"id": "old", "created": {"time": 1000}}]}),
        ("linkedin", "B", "socialActions", "urn:li:activity:1", None, 11, {
            "likesSummary": {"totalLikes": 4}, "commentsSummary": {"totalFirstLevelComments": 2},
            "totalShareStatistics": {"shareCount": 1}}),
        ("linkedin", "C", "socialActions", "urn:li:activity:123", None, 12, {
            "likesSummary": {"totalLikes": 4}, "totalShareStatistics": 0, "shares": 3}),
        ("linkedin", "C", "follower_statistics", None, None, 13, {"elements": [
            {"timeRange": {"end": t}, "followerCounts": {"organicFollowerCount": 0},
             "followerGains": {"organicFollowerGain": 8}}]}),
        ("linkedin", "C", "follower_countries", None, None, 14, {"elements": [
            {"timeRange": {"end": t}, "country": "us", "followerCountsByCountry": {"followerCount": 0},
             "followerCounts": {"organicFollowerCount": 4}},
            {"timeRange": {"end": t}, "aggregations": {"country": "US"}, "followerCountsByCountry": {"followerCount": 6}}]}),
    ])
    out = landed.linkedin(pg, "2024-03-05")
    posts = out["publicaciones"]
    assert rows(posts, "pagina_id", "publicacion_id", "url_publicacion", "formato") == [
        ("B", "u2", None, "ready"), ("B", "urn:li:share:1", "pl1", "post"), ("C", "123", None, "post"),
        ("C", "abc", None, "post")]
    daily = out["metricas_publicaciones_diarias"]
    # An object share count zeroes all three; '0' falls through to `shares`
    assert rows(daily, "publicacion_id", "fecha_descarga", "reacciones", "comentarios", "compartidos") == [
        ("123", D(2024, 3, 1), 4, 0, 3), ("abc", D(2024, 3, 1), 0, 0, 0), ("u2", D(2024, 3, 1), 0, 0, 0),
        ("urn:li:share:1", D(2024, 3, 1), 0, 0, 0)]
    # organicFollowerCount 0 is kept (gain only when NULL)
    assert rows(out["estadisticas_pagina_semanal"], "total_seguidores") == [(0,)]
    # A6 + G3: followerCount 0 falls through to organicFollowerCount 4; `us` seen first wins over `US`
    assert rows(out["segmentacion_seguidores_semanal"], "pais", "cantidad_seguidores", "fecha_corte_semana") == [
        ("US", 4, D(2024, 3, 5))]


def test_tiktok(spark, pages):
    pg = pages([
        ("tiktok", "tt", "videos", None, None, 1, {"data": {"creatives": [], "items": [
            {"creative_id": "v1", "create_time": "2024-02-01T00:00:00Z", "publish_time": "2023-12-31T10:00:00Z",
             "view_count": 0, "like_count": 2},
            {"id": "v2", "create_time": str(int(dt.datetime(2024, 2, 3, tzinfo=dt.timezone.utc).timestamp()))},
            {"caption": "no id", "create_time": "2024-02-01T00:00:00Z"},
            {"creative_id": "v3", "create_time": "2023-02-01T00:00:00Z"}]}}),
        ("tiktok", "tt", "video_insights", "v1", None, 2, {"data": {"insights": {"views": 8, "likes": 5, "saves": 1}}}),
        # a response with a counter that is not a number is discarded whole
        ("tiktok", "tt", "video_insights", "v2", None, 5, {"data": {"insights": {"views": 8, "reach": "n/a"}}}),
        ("tiktok", "tt", "account_insights", None, None, 3, {"data": {"values": [
            {"end_time": "2024-01-29T00:00:00Z", "value": {"views": 5, "followers": 10}},
            {"date": "2024-01-29", "value": {"views": 7}},
            {"date": "2024-01-30", "value": {"views": 1, "followers": 11}}]}}),
        ("tiktok", "tt", "audience", None, None, 4, {"data": {"by_country": [{"name": "BO", "count": 2},
                                                                             {"name": "BO", "count": 3}],
                                                             "by_age": [{"name": "18-24", "count": None}]}}),
    ])
    out = landed.tiktok(pg, "2024-01-31")
    assert rows(out["publicaciones"], "publicacion_id") == [("v1",), ("v2",)]
    # Kept by create time, dated by publish time; J4: view_count 0 -> insights 8
    assert rows(out["metricas_publicaciones_diarias"], "publicacion_id", "fecha_descarga", "visualizaciones",
                "me_gusta", "guardados") == [("v1", D(2023, 12, 31), 8, 2, 1), ("v2", D(2024, 2, 3), 0, 0, 0)]
    # The later point of 01-29 replaces the whole day (followers 0); A5 picks 01-30
    assert rows(out["estadisticas_pagina_semanal"], "fecha_corte_semana", "visualizaciones_pagina",
                "total_seguidores") == [(D(2024, 1, 30), 1, 11)]
    # Last wins (3, not 5); age tag
    assert rows(out["segmentacion_seguidores_semanal"], "genero", "pais", "cantidad_seguidores") == [
        ("AGE.18-24", None, 0), (None, "BO", 3)]

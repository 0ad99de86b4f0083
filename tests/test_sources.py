"""Raw readers, catalog writes and the whole pipeline on tiny JSON-lines fixtures."""

import json
import os
import struct
import zlib

from sparkplate.operators.lookup import with_poster
from sparkplate.operators.ids import encode_ratings
from sparkplate.plans.pipeline import run_pipeline, run_second_training
from sparkplate.sources import catalog as K
from sparkplate.sources import raw as Rw


def _write_jsonl(path, rows):
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def _fixtures(d):
    os.makedirs(d, exist_ok=True)
    biz = [{"business_id": f"b{i}", "name": ["Pho", "Pho", "Taco"][i % 3], "address": "x", "city": "C",
            "state": "S", "postal_code": "1", "latitude": 1.0, "longitude": 2.0, "stars": 3.5,
            "review_count": 10 + i, "is_open": i % 2, "categories": "Food, Bars",
            "hours": {"Monday": "9:0-22:0"}} for i in range(6)]
    users = [{"user_id": f"u{i}", "name": f"Ann {i}", "review_count": i, "yelping_since": "2015-01-01 00:00:00",
              "useful": 1, "funny": 2, "cool": 3, "elite": "", "friends": "", "fans": 0, "average_stars": 3.0}
             for i in range(5)]
    reviews = [{"review_id": f"r{i}", "user_id": f"u{i % 5}", "business_id": f"b{i % 6}", "stars": i % 5 + 1,
                "useful": 0, "funny": 0, "cool": 0, "text": "ok", "date": f"2020-01-{i % 28 + 1:02d} 10:00:00"}
               for i in range(60)]
    _write_jsonl(f"{d}/business.json", biz)
    _write_jsonl(f"{d}/user.json", users)
    _write_jsonl(f"{d}/review.json", reviews)
    _write_jsonl(f"{d}/checkin.json", [{"business_id": "b1", "date": "2020-01-01 10:00:00, 2020-01-02 10:00:00"}])
    _write_jsonl(f"{d}/tip.json", [{"user_id": "u1", "business_id": "b1", "text": "t", "date": "2020-01-01",
                                    "compliment_count": 0}])


def _png(path, w=2, h=3):
    raw = b"".join(b"\x00" + b"\x10\x20\x30" * w for _ in range(h))

    def chunk(t, data):
        return struct.pack(">I", len(data)) + t + data + struct.pack(">I", zlib.crc32(t + data) & 0xFFFFFFFF)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_raw_readers(spark, scratch):
    d = f"{scratch}/raw"
    _fixtures(d)
    biz = Rw.read_raw(spark, f"{d}/business.json", "business")
    assert biz.count() == 6 and biz.schema["hours"].dataType.fieldNames()[0] == "Monday"
    inferred = Rw.read_raw(spark, f"{d}/user.json", "user", infer=True)
    assert inferred.columns == sorted(inferred.columns)
    _write_jsonl(f"{d}/requests.json", [{"userid": 3, "res_num": 5, "token": "t"}])
    assert [tuple(r) for r in Rw.read_requests(spark, f"{d}/requests.json").collect()] == [(3, 5)]
    photos = Rw.read_photo_index(spark, f"{d}/missing-photos.json")
    assert photos.count() == 0 and photos.columns == ["business_id", "photo_id", "caption", "label"]
    posters = {r.business_id: r.poster for r in with_poster(biz.select("business_id"), photos).collect()}
    assert set(posters.values()) == {"fallback.jpg"}
    img = f"{scratch}/img"
    os.makedirs(img, exist_ok=True)
    _png(f"{img}/a.png")
    with open(f"{img}/junk.png", "wb") as f:
        f.write(b"not an image")
    info = Rw.image_info(Rw.read_images(spark, img)).collect()
    assert [(r.width, r.height) for r in info] == [(2, 3)]


def test_catalog_and_pipeline(spark, scratch):
    d = f"{scratch}/raw2"
    _fixtures(d)
    img = f"{scratch}/img2"
    os.makedirs(img, exist_ok=True)
    _png(f"{img}/a.png")
    out = run_pipeline(spark, d, model_path=f"{scratch}/model", images=img)
    assert set(out["checks"].values()) == {0} and len(out["checks"]) == 4
    assert out["analyses_review"].count() == 60
    names = {r.tableName for r in K.list_tables(spark, "bronze").collect()}
    assert {"restaurant", "user", "review", "checkin", "tip", "images", "restaurant_transform", "user_account"} <= names
    assert K.read_table(spark, "silver.dim_date").count() == 9863
    assert K.query(spark, "SELECT count(*) AS n FROM bronze.review WHERE stars >= :s", {"s": 3}).first().n == 36
    # silver and gold are catalog views: another session sees them
    assert spark.newSession().sql("SELECT count(*) AS n FROM gold.analyses_review").first().n == 60
    m = {r.metric: r.value for r in out["metrics"].collect()}
    assert out["metrics"].where("metric = 'model_path'").first().text == f"{scratch}/model"
    second = run_second_training(spark, encode_ratings(spark.table("feature_store.review"), own_keys=True))[1]
    assert second["training_nrows"] + second["test_nrows"] == 60 and second["train_rmse"] >= 0
    assert m["training_nrows"] + m["test_nrows"] == 60
    from sparkplate.operators.dashboards import apply_filters
    from sparkplate.plans.checks import pushed_filters
    pushed = pushed_filters(apply_filters(K.read_table(spark, "bronze.review"), {"stars": [4, 5]}))
    assert any("In(stars" in p for p in pushed)
    K.write_table(spark.range(3), "bronze.review")  # full refresh with a new schema
    assert K.read_table(spark, "bronze.review").columns == ["id"]


def test_incremental_ingest(spark, scratch):
    from sparkplate.streaming.ingest import ingest_stream
    d = f"{scratch}/stream-raw"
    os.makedirs(d, exist_ok=True)
    _write_jsonl(f"{d}/part-1.json", [{"user_id": "u1", "business_id": "b1", "text": "t", "date": "2020-01-01",
                                       "compliment_count": 1}])
    ckpt = f"{scratch}/stream-ckpt"
    ingest_stream(spark, d, "tip", "tips_stream", ckpt).awaitTermination(120)
    assert spark.table("tips_stream").count() == 1
    _write_jsonl(f"{d}/part-2.json", [{"user_id": "u2", "business_id": "b2", "text": "t", "date": "2020-01-02",
                                       "compliment_count": 0}] * 2)
    ingest_stream(spark, d, "tip", "tips_stream", ckpt).awaitTermination(120)
    assert spark.table("tips_stream").count() == 3  # each file appended exactly once

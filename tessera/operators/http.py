"""The service over HTTP with JSON bodies: /health, /check_duplicate, /search, /deduplicate_batch."""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import SparkSession

from tessera.config import REQUEST_THRESHOLD, TOP_K
from tessera.operators.serve import BadRequest, NotReady, Service


#: Bytes of a request's body at most: a full batch of long names.
MAX_BODY = 16 << 20


def answer(spark: SparkSession, service: Service, path: str, query: dict, body: dict) -> tuple[int, dict]:
    """(status, response) of one request."""
    try:
        if path == "/health":
            return 200, service.health()
        if path == "/check_duplicate":
            return 200, service.check_duplicate(spark, str(body["left"]), str(body["right"]), float(query.get("threshold", REQUEST_THRESHOLD)))
        if path == "/search":
            name = str(body["name"])
            rows = service.search(spark.createDataFrame([(name,)], "query string"), int(body.get("top_k", TOP_K)), float(body.get("min_score", 0))).orderBy("rank").collect()
            return 200, {
                "query": name,
                "normalized": rows[0].normalized if rows else None,
                "candidates_examined": rows[0].candidates if rows else 0,
                "results": [{"name": r.name, "score": r.score} for r in rows],
            }
        if path == "/deduplicate_batch":
            names = [str(x) for x in body["names"]]
            df = spark.createDataFrame(list(enumerate(names)), "position long, name string")
            ids = [r.cluster_id for r in service.deduplicate_batch(df, float(body.get("threshold", REQUEST_THRESHOLD))).orderBy("position").collect()]
            return 200, {"n_records": len(names), "n_clusters": len(set(ids)), "cluster_ids": ids}
    except NotReady as e:
        return 503, {"detail": str(e)}
    except (BadRequest, KeyError, TypeError, ValueError) as e:
        return 422, {"detail": f"{type(e).__name__}: {e}"}
    return 404, {"detail": "no such path"}


def serve(spark: SparkSession, service: Service, port: int = 8000, host: str = "0.0.0.0") -> ThreadingHTTPServer:
    """A server that is ready for serve_forever()."""

    class Handler(BaseHTTPRequestHandler):
        def _reply(self) -> None:
            url = urlparse(self.path)
            query = {k: v[-1] for k, v in parse_qs(url.query).items()}
            try:
                size = int(self.headers.get("Content-Length") or 0)
                body = json.loads(self.rfile.read(size) or b"{}") if 0 <= size <= MAX_BODY else None
            except ValueError:
                body = None
            status, reply = answer(spark, service, url.path, query, body) if isinstance(body, dict) else (422, {"detail": "not a JSON object"})
            data = json.dumps(reply, ensure_ascii=False).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _reply

    return ThreadingHTTPServer((host, port), Handler)

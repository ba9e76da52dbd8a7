"""One session at a time, one event after another: what the distributed jobs must equal."""


class Session:
    def __init__(self, cap=50, max_mappings=10_000):
        self.cap, self.max_mappings = cap, max_mappings
        self.map, self.requests = {}, {}

    def write(self, pairs):
        for placeholder, original in pairs:
            self.map[placeholder] = original
        while len(self.map) > self.max_mappings:
            del self.map[next(iter(self.map))]

    def open(self):
        return sum(r["status"] in ("pending", "follow_up") for r in self.requests.values())

    def request(self, placeholder, ts):
        if self.open() >= self.cap:
            return None
        rid = f"REQ-{len(self.requests) + 1}"
        self.requests[rid] = {
            "status": "pending",
            "original_text": self.map.get(placeholder),
            "created_at": ts,
            "resolved_at": None,
            "follow_up_message": None,
            "response_message": None,
        }
        return rid

    def resolve(self, rid, action, message, ts):
        """(status, error)"""
        r = self.requests.get(rid)
        if r is None:
            return None, f'Request "{rid}" not found.'
        if r["status"] in ("approved", "denied"):
            return None, f'Request "{rid}" is already {r["status"]}. Cannot resolve again.'
        if action == "follow_up":
            r["status"], r["follow_up_message"] = "follow_up", message
        else:
            r["status"] = "approved" if action == "approve" else "denied"
            r["resolved_at"], r["response_message"] = ts, message
        return r["status"], None


def run(events, cap=50, max_mappings=10_000):
    """events: dicts in any order -> (sessions, admissions, replies)"""
    sessions, made, replies = {}, {}, {}
    for e in sorted(events, key=lambda e: (e["session_id"], e["seq"])):
        s = sessions.setdefault(e["session_id"], Session(cap, max_mappings))
        key = (e["session_id"], e["seq"])
        if e["kind"] == "mapping":
            s.write([(e["placeholder"], e["original"])])
        elif e["kind"] == "request":
            made[key] = s.request(e["placeholder"], e["ts"])
        else:
            ids = e["request_ids"] or [e["request_id"]]
            for pos, rid in enumerate(ids):
                replies[(*key, pos)] = (rid, *s.resolve(rid, e["action"], e["message"], e["ts"]))
    return sessions, made, replies

"""Stand-ins for model clients: answers that follow from the request's text, so SQL can state them too."""

import json
import re
import uuid

_COMMITS = re.compile(r"^Commits: (\d+)$", re.M)
_LINES = re.compile(r"modified: (\d+)$", re.M)
_FILES = re.compile(r"^Files: (.*)$", re.M)
_NAME = re.compile(r"^Name: (.*)$", re.M)
_PICTURE = re.compile(r"^data:image/png;base64,(.*)$", re.M)


def quality_client():
    def complete(request: str) -> str:
        commits = int(_COMMITS.search(request).group(1))
        lines = int(_LINES.search(request).group(1))
        files = _FILES.search(request).group(1)
        count = len(files.split(", ")) if files else 0
        # An impact of 0 is out of range: that answer is not valid.
        return json.dumps(
            {"impact_to_project": commits % 11, "technical_ability": 1 + lines % 10, "reason": f"{count} files"}
        )

    return complete


def project_client():
    async def complete(request: str) -> str:
        name = _NAME.search(request).group(1)
        readme = request.partition("README: ")[2].rpartition("\n\nAnswer with JSON")[0]
        if readme == "None":
            raise ValueError("nothing to describe")
        return json.dumps({"languages": ["rust", "c"], "keywords": [f"of {name}", f"{len(readme)} long"]})

    return complete


def picture_client():
    async def complete(request: str) -> str:
        encoded = _PICTURE.search(request).group(1)
        return json.dumps({"score": len(encoded) / 8, "reason": encoded[:4]})

    return complete


def stamping_client(failing: str | None = None):
    """Every call's answer is its own; requests that contain ``failing`` get none."""

    def make():
        def complete(request: str) -> str:
            if failing is not None and failing in request:
                raise ValueError("not now")
            return uuid.uuid4().hex

        return complete

    return make

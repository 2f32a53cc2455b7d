"""A webhook that takes short messages: one host list, no redirects, nothing secret in errors."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import HTTPRedirectHandler, Request, build_opener

# Hosts that webhooks may be at.
HOSTS = frozenset({"hooks.slack.com", "hooks.slack-gov.com"})
LONGEST_TIMEOUT = 10.0


class DeliveryError(RuntimeError):
    """A message was not accepted; its text names neither the address nor the answer."""


def checked_url(url: str) -> str:
    """The address of a webhook, if it is one."""
    url = url.strip()
    try:
        parts = urlsplit(url)
        path = parts.path.split("/")
        plain = bool(url) and "\\" not in url and all(32 < ord(c) != 127 for c in url)
        place = parts.scheme == "https" and parts.hostname in HOSTS and parts.port in (None, 443) and parts.username is None and parts.password is None
        tidy = not parts.query and not parts.fragment and len(path) == 5 and path[:2] == ["", "services"] and all(path[2:])
    except ValueError:
        plain = place = tidy = False
    if not (plain and place and tidy):
        raise DeliveryError("The webhook address is missing or not valid.")
    return url


class _NoRedirect(HTTPRedirectHandler):
    def redirect_request(self, *args: object) -> None:
        raise DeliveryError("The webhook answered with a redirect.")


def post(url: str, body: bytes, timeout: float) -> tuple[int, bytes]:
    request = Request(url, data=body, headers={"Content-Type": "application/json; charset=utf-8"}, method="POST")
    with build_opener(_NoRedirect()).open(request, timeout=timeout) as answer:
        return answer.status, answer.read(1024)


@dataclass
class Webhook:
    """Sends text; does nothing where it is not enabled."""

    url: str = ""
    enabled: bool = False
    timeout: float = 3.0
    post: Callable[[str, bytes, float], tuple[int, bytes]] = post

    def send(self, text: str) -> bool:
        if not self.enabled:
            return False
        if not 0 < self.timeout <= LONGEST_TIMEOUT:
            raise DeliveryError("The timeout must be above 0 and at most 10 seconds.")
        url = checked_url(self.url)
        try:
            status, body = self.post(url, json.dumps({"text": text}).encode(), self.timeout)
        except HTTPError as error:
            raise DeliveryError(f"The webhook answered with status {error.code}.") from None
        except (OSError, ValueError):
            raise DeliveryError("The webhook could not be reached.") from None
        if not 200 <= status < 300 or body.strip() != b"ok":
            raise DeliveryError(f"The webhook did not take the message (status {status}).")
        return True

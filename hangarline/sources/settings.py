"""Connection settings of the operational PostgreSQL database."""

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

# Key in the settings file, suffix of the environment variable.
SETTING_KEYS = {
    "dbname": "NAME",
    "user": "USER",
    "password": "PASSWORD",
    "ip": "HOST",
    "port": "PORT",
}


@dataclass(frozen=True)
class ConnectionSettings:
    dbname: str
    user: str
    password: str = field(repr=False)
    ip: str
    port: str

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.ip}:{self.port}/{self.dbname}"


def _file_settings(path: Path) -> dict[str, str]:
    """What the lines of a file say about known settings: a name, an equals sign, a value. Other lines are ignored."""
    lines = (line.partition("=") for line in path.read_text().splitlines())
    return {name.strip(): value.strip() for name, sign, value in lines if sign and name.strip() in SETTING_KEYS}


def read_settings(
    path: str | Path | None = None,
    env: Mapping[str, str] | None = None,
    env_prefix: str = "FLEET_DB_",
) -> ConnectionSettings:
    """The settings from environment variables, and from a file where these are unset or empty."""
    env = os.environ if env is None else env
    variables = {key: env_prefix + suffix for key, suffix in SETTING_KEYS.items()}
    in_file = _file_settings(Path(path)) if path is not None and Path(path).is_file() else {}
    values = {key: env.get(variable) or in_file.get(key) for key, variable in variables.items()}
    if missing := [key for key, value in values.items() if value is None]:
        names = ", ".join(variables[key] for key in missing)
        raise FileNotFoundError(f"missing database settings {missing}: add them to {path} or set {names}")
    return ConnectionSettings(**values)

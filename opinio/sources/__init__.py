"""Landing files, tables and the stand-in inputs."""

"""flowlens: network-traffic analytics as Spark DataFrame jobs.

Packets are rows with a BINARY frame column; every header field is read with
Catalyst expressions (``substring``/``hex``/``conv``), so decoding stays inside
whole-stage codegen and the optimizer prunes whatever a job does not use.
"""

from flowlens.session import clean_work, get_session, ship_package, work_dir

__all__ = ["clean_work", "get_session", "ship_package", "work_dir"]

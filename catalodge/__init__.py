"""catalodge: catalogue pages, registries and entity tables as Spark jobs.

Every public function takes and returns DataFrames or Columns. Nothing here
keeps data on the driver, and nothing but a streaming sink starts a job.
"""

__version__ = "0.1.0"

"""Copy the small files of a streaming job's changelog into large ones: run_compaction.py BASE."""

import sys

from mentionscope.plans import stream_job
from mentionscope.session import build_session

if __name__ == "__main__":
    print(stream_job.compact_changelog(build_session("mentionscope-compaction"), sys.argv[1]), "files compacted")

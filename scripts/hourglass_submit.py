"""spark-submit driver: ``spark-submit --py-files hourglass.zip scripts/hourglass_submit.py run ...``"""

from hourglass.__main__ import main

raise SystemExit(main())

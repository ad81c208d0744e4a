"""spark-submit entry file for the batch jobs (see ``shotframe/jobs.py``).

    zip -r shotframe.zip shotframe
    spark-submit --py-files shotframe.zip run_job.py process \
        --raw 'hdfs:///raw/*.csv' --table hdfs:///processed/shots --out hdfs:///tables
"""

from shotframe.jobs import main

if __name__ == "__main__":
    main()
